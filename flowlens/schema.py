"""Flow schema and label taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Field order and types of a headerless flow file.
FLOW_DDL = """
    duration BIGINT, protocol_type STRING, service STRING, flag STRING,
    src_bytes BIGINT, dst_bytes BIGINT, land BIGINT, wrong_fragment BIGINT,
    urgent BIGINT, hot BIGINT, num_failed_logins BIGINT, logged_in BIGINT,
    num_compromised BIGINT, root_shell BIGINT, su_attempted BIGINT, num_root BIGINT,
    num_file_creations BIGINT, num_shells BIGINT, num_access_files BIGINT,
    num_outbound_cmds BIGINT, is_host_login BIGINT, is_guest_login BIGINT,
    count BIGINT, srv_count BIGINT, serror_rate DOUBLE, srv_serror_rate DOUBLE,
    rerror_rate DOUBLE, srv_rerror_rate DOUBLE, same_srv_rate DOUBLE,
    diff_srv_rate DOUBLE, srv_diff_host_rate DOUBLE, dst_host_count BIGINT,
    dst_host_srv_count BIGINT, dst_host_same_srv_rate DOUBLE,
    dst_host_diff_srv_rate DOUBLE, dst_host_same_src_port_rate DOUBLE,
    dst_host_srv_diff_host_rate DOUBLE, dst_host_serror_rate DOUBLE,
    dst_host_srv_serror_rate DOUBLE, dst_host_rerror_rate DOUBLE,
    dst_host_srv_rerror_rate DOUBLE, label STRING
"""
DIFFICULTY_DDL = "difficulty INT"

# Attack names of each class.
ATTACKS_BY_CATEGORY = {
    "Normal": ["normal"],
    "DoS": ["back", "land", "neptune", "pod", "smurf", "teardrop", "mailbomb", "processtable",
            "udpstorm", "apache2", "worm"],
    "Probe": ["satan", "ipsweep", "nmap", "portsweep", "mscan", "saint"],
    "R2L": ["guess_passwd", "ftp_write", "imap", "phf", "multihop", "warezmaster", "warezclient",
            "spy", "xlock", "xsnoop", "snmpguess", "snmpgetattack", "httptunnel", "sendmail",
            "named"],
    "U2R": ["buffer_overflow", "loadmodule", "rootkit", "perl", "sqlattack", "xterm", "ps"],
}

# Display order of the classes and the labels written by the router.
CATEGORY_ORDER = ["Normal", "DoS", "Probe", "R2L", "U2R"]
BINARY_ORDER = ["Normal", "Attack"]
UNKNOWN_CATEGORY = "Unknown"
SUSPECT_LABEL = "Unknown/Zero-Day Suspect"
CONF_THRESHOLD = 0.60

NOMINAL_COLUMNS = ["protocol_type", "service", "flag"]
# Columns that describe a row but are not model inputs.
NON_FEATURE_COLUMNS = {
    "label", "attack_type", "category", "binary_label", "difficulty",
    "flow_id", "split",
}


_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
          "STRING": T.StringType()}


def flow_schema(with_difficulty: bool = False) -> T.StructType:
    ddl = FLOW_DDL + (", " + DIFFICULTY_DDL if with_difficulty else "")
    fields = [f.split() for f in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def taxonomy(spark: SparkSession) -> DataFrame:
    """One row per attack name: ``attack_type, category``."""
    rows = [(name, category)
            for category, names in ATTACKS_BY_CATEGORY.items()
            for name in names]
    return spark.createDataFrame(rows, "attack_type string, category string")


def feature_columns(columns: list[str],
                    nominal: list[str] = NOMINAL_COLUMNS) -> tuple[list[str], list[str]]:
    """Split a column list into (all features, numeric features), keeping order."""
    features = [c for c in columns if c not in NON_FEATURE_COLUMNS]
    return features, [c for c in features if c not in nominal]
