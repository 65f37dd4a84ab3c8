"""Fixed values shared by the operators.

Everything in the block below must equal the values the original analytics
pipeline uses, otherwise labels, segments and sweeps give different results.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline exactly)
# ---------------------------------------------------------------------------

# Raw connection-record columns, in file order.
RAW_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
    "land", "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in",
    "num_compromised", "root_shell", "su_attempted", "num_root", "num_file_creations",
    "num_shells", "num_access_files", "num_outbound_cmds", "is_hot_login", "is_guest_login",
    "count", "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
    "class", "difficulty_score",
]

TARGET_COLUMN = "class"
COLUMNS_TO_DROP = ["difficulty_score", "num_outbound_cmds"]
CATEGORICAL = ["protocol_type", "service", "flag"]
BINARY = ["land", "logged_in", "root_shell", "is_hot_login", "is_guest_login"]
SKEWED = ["duration", "src_bytes", "dst_bytes"]
ROBUST = ["count", "srv_count", "hot", "num_failed_logins", "num_compromised", "num_root",
          "num_file_creations", "num_shells", "num_access_files"]
RATE = ["serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate", "same_srv_rate",
        "diff_srv_rate", "srv_diff_host_rate", "dst_host_count", "dst_host_srv_count",
        "dst_host_same_srv_rate", "dst_host_diff_srv_rate", "dst_host_same_src_port_rate",
        "dst_host_srv_diff_host_rate", "dst_host_serror_rate", "dst_host_srv_serror_rate",
        "dst_host_rerror_rate", "dst_host_srv_rerror_rate"]
TRAIN_RATIO = 0.8
RANDOM_STATE = 42
RARE_THRESHOLD = 0.01
FILL_VALUE = "other"

# Attack name -> family id (0 normal, 1 DoS, 2 Probe, 3 R2L, 4 U2R); unknown -> 3.
ATTACK_FAMILY = {
    "apache2": 1, "back": 1, "land": 1, "neptune": 1, "pod": 1, "smurf": 1,
    "teardrop": 1, "mailbomb": 1, "processtable": 1, "udpstorm": 1, "worm": 1,
    "ipsweep": 2, "mscan": 2, "nmap": 2, "portsweep": 2, "saint": 2, "satan": 2,
    "ftp_write": 3, "guess_passwd": 3, "imap": 3, "multihop": 3, "phf": 3,
    "spy": 3, "warezclient": 3, "warezmaster": 3, "sendmail": 3, "named": 3,
    "snmpgetattack": 3, "snmpguess": 3, "xlock": 3, "xsnoop": 3, "httptunnel": 3,
    "buffer_overflow": 4, "loadmodule": 4, "perl": 4, "ps": 4, "rootkit": 4,
    "sqlattack": 4, "xterm": 4,
    "normal": 0,
}
UNKNOWN_FAMILY = 3

# Exploratory taxonomy (no default: unknown -> null; worm is R2L; no httptunnel).
EDA_CATEGORY = {
    "neptune": "DoS", "back": "DoS", "smurf": "DoS", "teardrop": "DoS", "pod": "DoS", "land": "DoS",
    "apache2": "DoS", "mailbomb": "DoS", "processtable": "DoS", "udpstorm": "DoS",
    "satan": "Probe", "ipsweep": "Probe", "nmap": "Probe", "portsweep": "Probe", "mscan": "Probe", "saint": "Probe",
    "guess_passwd": "R2L", "ftp_write": "R2L", "imap": "R2L", "warezclient": "R2L", "warezmaster": "R2L",
    "multihop": "R2L", "phf": "R2L", "spy": "R2L", "sendmail": "R2L", "named": "R2L", "snmpgetattack": "R2L",
    "snmpguess": "R2L", "xlock": "R2L", "xsnoop": "R2L", "worm": "R2L",
    "buffer_overflow": "U2R", "loadmodule": "U2R", "rootkit": "U2R", "perl": "U2R", "sqlattack": "U2R",
    "ps": "U2R", "xterm": "U2R",
    "normal": "Normal",
}

# Attack names present in the training data ("seen"); any other non-normal is "novel".
SEEN_ATTACKS = [
    "back", "buffer_overflow", "ftp_write", "guess_passwd", "imap", "ipsweep", "land",
    "loadmodule", "multihop", "neptune", "nmap", "perl", "phf", "pod", "portsweep",
    "rootkit", "satan", "smurf", "spy", "teardrop", "warezclient", "warezmaster",
]

# Family id -> display name used by the serving response.
FAMILY_NAME = {0: "normal", 1: "dos", 2: "probe", 3: "r2l", 4: "u2r"}

# Threshold sweep grid 0.30 .. 0.70 step 0.05 and the target operating point.
THRESHOLDS = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]
TARGET_NOVEL_RECALL = 0.80
TARGET_FPR = 0.06

# Override-threshold sweep of the two-stage rule; None = always override.
T_STRICT_SWEEP = [None, -0.25, -0.20, -0.15, -0.12, -0.10, -0.08, -0.05, -0.02, 0.00]

# Isolation-forest and LOF benchmark grids.
IF_CONTAMINATIONS = [0.05, 0.10, 0.12, 0.15, 0.18, 0.20, 0.30, 0.40, 0.44, "auto"]
LOF_NEIGHBORS = [10, 20, 50]
LOF_CONTAMINATIONS = ["auto", 0.10, 0.20, 0.44]
IF_TREES = 100
IF_MAX_SAMPLES = 256
HYBRID_CONTAMINATION = 0.20
UNIFORM_SUBSAMPLE_SIZE = 10000
SUBSAMPLE_SIZE = 10000

# Stage-2 router preference list (first available model is used, else a fallback forest).
ROUTER_PREFERENCE = [
    "xgboost_boosting_ensembles",
    "random_forest_bagging_ensembles",
    "logistic_regression_cs_cost_sensitive",
    "naive_bayes",
]
