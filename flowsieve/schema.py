"""Names, schemas and parameters shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# The 15 modelled features, in model order (CSV header name, column name here).
FEATURE_NAMES = [
    ("Flow Duration", "flow_duration"),
    ("Total Fwd Packets", "fwd_packets"),
    ("Total Backward Packets", "bwd_packets"),
    ("Total Length of Fwd Packets", "fwd_len_total"),
    ("Total Length of Bwd Packets", "bwd_len_total"),
    ("Fwd Packet Length Max", "fwd_len_max"),
    ("Fwd Packet Length Min", "fwd_len_min"),
    ("Fwd Packet Length Mean", "fwd_len_mean"),
    ("Bwd Packet Length Max", "bwd_len_max"),
    ("Bwd Packet Length Min", "bwd_len_min"),
    ("Bwd Packet Length Mean", "bwd_len_mean"),
    ("Flow Bytes/s", "flow_bytes_s"),
    ("Flow Packets/s", "flow_packets_s"),
    ("Flow IAT Mean", "flow_iat_mean"),
    ("Flow IAT Max", "flow_iat_max"),
]
FEATURES = [snake for _, snake in FEATURE_NAMES]

# Label columns in order of preference, and the texts that mean benign.
LABEL_COLUMNS = ["Label", "label", "Class", "class"]
BENIGN_LABELS = ["benign", "0", "normal"]

# Fixed values: (file name token, attack family), first match wins.
ATTACK_FAMILIES = [
    ("ddos", "DDoS"),
    ("portscan", "PortScan"),
    ("tuesday", "Patator (FTP/SSH)"),
    ("wednesday", "DoS (Hulk/GoldenEye/Slow)"),
    ("webattacks", "Web Attacks (SQL/XSS/BF)"),
    ("infilteration", "Infiltration"),
    ("morning", "Botnet"),
]
NO_FAMILY = "Benign"

# Workload parameters.
SEED = 42
FLOW_SIZE = 10                 # packets that close a flow
ALERT_THRESHOLD = 0.5
TRAIN_FILE_CAP = 40_000        # rows kept per training file
TRAIN_CAP = 40_000             # rows kept after balancing
SINGLE_EVAL_CAP = 50_000       # rows kept when one file is evaluated
CROSS_EVAL_CAP = 100_000       # rows kept per file in the cross-dataset table
TEST_FRACTION = 0.2
BASE_RATES = {"bayes_01": 0.001, "bayes_50": 0.05}

# Model codes, display names and hyper-parameters.
MODEL_NAMES = {
    "rf": "Random Forest",
    "xgb": "XGBoost",
    "dt": "Decision Tree",
    "et": "Extra Trees",
    "ada": "AdaBoost",
    "gb": "Gradient Boosting",
    "knn": "K-Nearest Neighbors",
    "lr": "Logistic Regression",
    "svm": "Linear SVM",
    "nb": "Naive Bayes",
}
MODEL_PARAMS = {
    "rf": {"trees": 100, "depth": 15},
    "xgb": {"rounds": 100, "depth": 6, "rate": 0.1},
    "dt": {"depth": 12},
    "et": {"trees": 100, "depth": 15},
    "ada": {"rounds": 50},
    "gb": {"rounds": 50, "depth": 5, "rate": 0.1},
    "knn": {"k": 5},
    "lr": {"max_iter": 1000, "c": 1.0},
    "svm": {"max_iter": 1000, "c": 1.0},
    "nb": {"smoothing": 1e-9},
}
IFOREST_PARAMS = {"trees": 100, "sample": 256, "contamination": 0.01}
DEPTH_STUDY = [3, 5, 8, 12, 20, None]

PACKET_SCHEMA = T.StructType([
    T.StructField("packet_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("is_ip", T.BooleanType()),
    T.StructField("proto", T.IntegerType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("src_port", T.LongType()),
    T.StructField("dst_port", T.LongType()),
    T.StructField("length", T.LongType()),
])

# A flow is identified by its end points in string order plus the protocol.
FLOW_KEY = ["ip_a", "ip_b", "port_a", "port_b", "proto"]
