"""cohortlens: survey-table analytics on Spark.

Curate, profile, rate, select features, train and score classifiers over
large survey-style tables, expressed as DataFrame and Spark ML operations.
"""

from .spec import ANALOG, HEART, ScoreRule, SurveySpec  # noqa: F401

__all__ = ["ANALOG", "HEART", "ScoreRule", "SurveySpec"]
