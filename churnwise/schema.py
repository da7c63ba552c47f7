"""Data model: the member snapshot schema, feature groups and fixed constants.

The values below must equal the reference's for identical results; they are
fixed values, listed in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Member snapshot columns (raw features in file order) + target.
# ---------------------------------------------------------------------------
TARGET = "Churn"
RAW_FEATURES = [
    "gender",
    "Near_Location",
    "Partner",
    "Promo_friends",
    "Phone",
    "Contract_period",
    "Group_visits",
    "Age",
    "Avg_additional_charges_total",
    "Month_to_end_contract",
    "Lifetime",
    "Avg_class_frequency_total",
    "Avg_class_frequency_current_month",
]
BINARY_FEATURES = ["gender", "Near_Location", "Partner", "Promo_friends", "Phone", "Group_visits"]
NUMERIC_FEATURES = [
    "Contract_period",
    "Age",
    "Avg_additional_charges_total",
    "Lifetime",
    "Avg_class_frequency_total",
    "Avg_class_frequency_current_month",
]
WINSORIZE_FEATURES = [
    "Avg_additional_charges_total",
    "Avg_class_frequency_total",
    "Avg_class_frequency_current_month",
]
WINSORIZE_PERCENTILE = 99
DERIVED_NUMERIC = ["ratio_freq_atual_vs_lifetime", "delta_freq", "contract_x_lifetime"]
DERIVED_BINARY = ["flag_early_user", "flag_sleeping_dog"]
LEAKY_FEATURES = ["Month_to_end_contract"]

# Which features operations can act on.
ACTIONABLE = {
    "gender": False,
    "Near_Location": False,
    "Partner": True,
    "Promo_friends": True,
    "Phone": False,
    "Contract_period": True,
    "Group_visits": True,
    "Age": False,
    "Avg_additional_charges_total": True,
    "Lifetime": False,
    "Avg_class_frequency_total": True,
    "Avg_class_frequency_current_month": True,
    "ratio_freq_atual_vs_lifetime": True,
    "delta_freq": True,
    "contract_x_lifetime": True,
    "flag_early_user": False,
    "flag_sleeping_dog": False,
}

# The legacy analysis service feature list (11 columns), its
# binary subset and its fallback values.
LEGACY_FEATURES = [
    "Lifetime",
    "Avg_class_frequency_current_month",
    "Age",
    "Contract_period",
    "Month_to_end_contract",
    "Avg_class_frequency_total",
    "Avg_additional_charges_total",
    "Group_visits",
    "Promo_friends",
    "Partner",
    "Near_Location",
]
LEGACY_BINARY = ["Group_visits", "Promo_friends", "Partner", "Near_Location"]
LEGACY_DEFAULTS = {
    "Lifetime": 4,
    "Avg_class_frequency_current_month": 2.0,
    "Age": 29,
    "Contract_period": 6,
    "Month_to_end_contract": 4.0,
    "Avg_class_frequency_total": 2.0,
    "Avg_additional_charges_total": 150.0,
    "Group_visits": 0,
    "Promo_friends": 0,
    "Partner": 0,
    "Near_Location": 1,
}
LEGACY_NUMERIC = [f for f in LEGACY_FEATURES if f not in LEGACY_BINARY]

# Seed, splits, costs, thresholds.
SEED = 42
TEST_SIZE = 0.15
VAL_SIZE = 0.15
KFOLDS = 5
COST_FN = 10.0
COST_FP = 2.0
COST_TP = 1.0
COST_TN = 0.0
MIN_RECALL = 0.70
MODEL_VERSION = "churnwise-1.0.0"
HEURISTIC_VERSION = "heuristic-fallback-0.1"
DEFAULT_THRESHOLD = 0.5

# Threshold economics defaults (retention cost, churn loss, save rate).
RETENTION_COST = 40.0
CHURN_LOSS = 712.0
SAVE_RATE = 0.35

# Tiers and archetypes, in display order.
TIERS = ["baixo", "medio", "alto", "critico"]
ARCHETYPES = ["preco_sensivel", "desengajado_conteudo", "early_dropper", "sleeping_dog", "concorrente_driven"]
INTERVENTION_STATUS = ["sugerida", "aplicada", "bloqueada", "concluida"]

# Snapshot cut for the member stand-in source (FIXTURES §2).
SNAPSHOT_CUT = "2001-01-01"
HISTORY_START = "1997-01-01"
CURRENT_START = "2000-01-01"


def model_feature_list() -> list[str]:
    """Raw minus leaky, then derived numeric, then derived binary."""
    return [f for f in RAW_FEATURES if f not in LEAKY_FEATURES] + DERIVED_NUMERIC + DERIVED_BINARY


_INT_COLS = {"gender", "Near_Location", "Partner", "Promo_friends", "Phone", "Contract_period",
             "Group_visits", "Age", "Lifetime"}

MEMBER = T.StructType(
    [T.StructField(c, T.IntegerType() if c in _INT_COLS else T.DoubleType(), True) for c in RAW_FEATURES]
    + [T.StructField(TARGET, T.IntegerType(), True)]
)
"""Fixed schema of a member file (no inference)."""

MEMBER_KEYED = T.StructType([T.StructField("customer_id", T.LongType(), False)] + MEMBER.fields)

FEATURES_STRUCT = T.StructType([f for f in MEMBER.fields if f.name != TARGET])
"""Schema of the JSON ``features`` column of a customer row."""
