"""Fixed values.

Everything in this module is a value that has to be exactly this for results to agree with the
systems that consume them: thresholds, class names, price list, role table, bucket bounds and
text patterns. Nothing here is logic.
"""

# -- vital-sign classes ------------------------------------------------------------------------
SYSTOLIC_LOW = 90
DIASTOLIC_LOW = 60
SYSTOLIC_HIGH = 140
DIASTOLIC_HIGH = 90
PRESSURE_LOW_NAME = "baixa"
PRESSURE_HIGH_NAME = "alta"
HEART_RATE_LOW = 60
HEART_RATE_HIGH = 100
HEART_SLOW_NAME = "bradicardia"
HEART_FAST_NAME = "taquicardia"
NORMAL_NAME = "normal"
FEVER_FROM = 37.8

# -- personal fields ---------------------------------------------------------------------------
SENSITIVE_FIELDS = ("cpf", "patient_id", "nome", "email", "telefone")
MASK_FILL = "***"
PHONE_MASK_PREFIX = "(**) *****-"
GENERIC_MASK_PATTERN = r"(^.{3}).*"
GENERIC_MASK_REPLACEMENT = "$1***"

# -- domain rules of the consistency score: closed ranges and allowed codes ----------------------
VALID_RANGES = {
    "heart_rate": (30, 220),
    "temperatura": (34.0, 42.0),
    "saturacao_o2": (70, 100),
    "idade": (0, 130),
}
VALID_CODES = {"sexo": ("M", "F")}

# -- quality score -------------------------------------------------------------------------------
SCORE_WEIGHTS = {"completeness": 0.30, "uniqueness": 0.25, "consistency": 0.25, "timeliness": 0.20}
TEXT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
MAX_AGE_HOURS = 24
NULL_ALERT_PCT = 30
NULL_ALERT_RATIO = 0.3
DUPLICATE_ALERT_RATIO = 0.05

# -- price list (US$) ----------------------------------------------------------------------------
PRICES = {
    "node_hour": 0.126,
    "storage_gb_month": 0.023,
    "put_per_1000": 0.005,
    "transfer_gb": 0.09,
    "database_hour": 0.068,
    "broker_hour": 0.21,
}
BROKER_COUNT = 3
DAYS_PER_MONTH = 30

# -- operational limits --------------------------------------------------------------------------
STAGE_TIMEOUT_SECONDS = 600
ERROR_RATE_PER_SECOND = 0.1
STREAM_LAG_SECONDS = 300
DURATION_BOUNDS = (0.1, 0.5, 1, 5, 10, 30, 60, 120, 300, 600)
RECORD_SIZE_BOUNDS = (100, 500, 1000, 5000, 10000, 50000)

# -- roles ---------------------------------------------------------------------------------------
ROLE_PERMISSIONS = {
    "admin": ("read", "write", "delete", "mask", "export"),
    "analista": ("read", "write"),
    "cientista_dados": ("read", "write", "export"),
    "visitante": ("read",),
}
USER_ROLES = {
    "admin": "admin",
    "analista_01": "analista",
    "cientista_01": "cientista_dados",
    "visitante_01": "visitante",
}
LAYER_READERS = {
    "bronze": ("admin",),
    "silver": ("admin", "analista"),
    "gold": ("admin", "analista", "cientista_dados", "visitante"),
}

# -- serving columns a refresh never copies ------------------------------------------------------
GENERATED_COLUMNS = ("id", "created_at")

# fixed values: findings about a column's profile and their severities
FINDINGS = {"high_null_ratio": "warning", "constant_column": "info", "zero_variance": "warning"}
