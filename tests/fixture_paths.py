"""Where the driver's tables lie (a plain module: conftest is a name that several folders share)."""

SF_SMALL = "/root/testdata/sf0.001"
