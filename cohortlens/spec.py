"""Table contracts: column order, column kinds and the derived-column rules.

A ``SurveySpec`` names every column an operator touches, so operators never
hard-code the survey's names. ``HEART`` is the 22-column heart-disease
contract; ``ANALOG`` is the same contract over the driver's ``lineitem``
table (see ``sources.analog``), which differs only in the clean range of the
measure column.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the heart-disease contract (must equal the source survey's).
# Column names, in contract order; the target comes first.
HEART_COLUMNS = (
    "HeartDiseaseorAttack", "HighBP", "HighChol", "CholCheck", "BMI", "Smoker",
    "Stroke", "Diabetes", "PhysActivity", "Fruits", "Veggies",
    "HvyAlcoholConsump", "AnyHealthcare", "NoDocbcCost", "GenHlth", "MentHlth",
    "PhysHlth", "DiffWalk", "Sex", "Age", "Education", "Income",
)
HEART_TARGET = "HeartDiseaseorAttack"
# The diabetes table (the subset search's): the same survey with another target.
DIABETES_TARGET = "Diabetes_binary"
DIABETES_COLUMNS = (
    "Diabetes_binary", "HighBP", "HighChol", "CholCheck", "BMI", "Smoker",
    "Stroke", "HeartDiseaseorAttack", "PhysActivity", "Fruits", "Veggies",
    "HvyAlcoholConsump", "AnyHealthcare", "NoDocbcCost", "GenHlth", "MentHlth",
    "PhysHlth", "DiffWalk", "Sex", "Age", "Education", "Income",
)
# Columns whose only values are 0 and 1 (the prevalence-by-factor set).
HEART_BINARY = (
    "HighBP", "HighChol", "CholCheck", "Smoker", "Stroke", "PhysActivity",
    "Fruits", "Veggies", "HvyAlcoholConsump", "AnyHealthcare",
    "NoDocbcCost", "DiffWalk", "Sex",
)
# Age code bands: right-closed intervals (0,4] (4,7] (7,10] (10,13].
AGE_EDGES = (0, 4, 7, 10, 13)
AGE_LABELS = ("1_18a39", "2_40a54", "3_55a69", "4_70ymas")
# Kept range of BMI, inclusive on both ends, and the healthy cut (strict).
HEART_MEASURE_RANGE = (12.0, 60.0)
HEALTHY_MEASURE_BELOW = 25.0
TOP_N = 10
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoreRule:
    """Seven-point health score: one point per healthy component."""

    non_smoker: str = "Smoker"          # == 0
    active: str = "PhysActivity"        # == 1
    fruit: str = "Fruits"               # fruit == 1 AND vegetables == 1
    vegetables: str = "Veggies"
    measure: str = "BMI"                # < healthy_below (strict)
    healthy_below: float = HEALTHY_MEASURE_BELOW
    pressure: str = "HighBP"            # == 0
    cholesterol: str = "HighChol"       # == 0
    diabetes: str = "Diabetes"          # == 0 (three levels, 0 is healthy)


@dataclass(frozen=True)
class SurveySpec:
    columns: tuple[str, ...]
    target: str
    binary: tuple[str, ...]
    measure: str
    measure_range: tuple[float, float]
    age: str = "Age"
    sex: str = "Sex"
    age_edges: tuple[int, ...] = AGE_EDGES
    age_labels: tuple[str, ...] = AGE_LABELS
    score: ScoreRule = field(default_factory=ScoreRule)
    score_col: str = "health_score"
    band_col: str = "age_band"
    weight_col: str = "class_weight"
    id_col: str | None = None

    @property
    def predictors(self) -> list[str]:
        return [c for c in self.columns if c != self.target]

    @property
    def raw_schema(self) -> T.StructType:
        """Read schema: every contract column as double, never inferred."""
        return T.StructType([T.StructField(c, T.DoubleType(), True) for c in self.columns])

    @property
    def curated_schema(self) -> T.StructType:
        """Curated table: id (if any), contract columns and score as short, band as string.

        Handing it to the reader skips footer schema inference on every scan.
        """
        fields = [T.StructField(self.id_col, T.LongType(), True)] if self.id_col else []
        fields += [T.StructField(c, T.ShortType(), True) for c in (*self.columns, self.score_col)]
        fields.append(T.StructField(self.band_col, T.StringType(), True))
        return T.StructType(fields)

    def with_(self, **kw) -> "SurveySpec":
        return replace(self, **kw)


HEART = SurveySpec(
    columns=HEART_COLUMNS,
    target=HEART_TARGET,
    binary=HEART_BINARY,
    measure="BMI",
    measure_range=HEART_MEASURE_RANGE,
)

# The lineitem analog: same names; l_quantity (1-50) plays BMI, kept 2-48.
ANALOG = HEART.with_(measure_range=(2.0, 48.0), id_col="respondent_id")

DIABETES = HEART.with_(columns=DIABETES_COLUMNS, target=DIABETES_TARGET,
                       binary=(*HEART_BINARY, "HeartDiseaseorAttack"))
