"""Hand-made survey rows (heart contract) for unit tests."""

from cohortlens.spec import HEART

HEALTHY = dict(HeartDiseaseorAttack=0.0, HighBP=0.0, HighChol=0.0, CholCheck=1.0, BMI=22.0, Smoker=0.0,
               Stroke=0.0, Diabetes=0.0, PhysActivity=1.0, Fruits=1.0, Veggies=1.0, HvyAlcoholConsump=0.0,
               AnyHealthcare=1.0, NoDocbcCost=0.0, GenHlth=1.0, MentHlth=0.0, PhysHlth=0.0, DiffWalk=0.0,
               Sex=0.0, Age=5.0, Education=6.0, Income=8.0)
UNHEALTHY = dict(HEALTHY, HighBP=1.0, HighChol=1.0, BMI=31.0, Smoker=1.0, Diabetes=2.0, PhysActivity=0.0,
                 Fruits=0.0, Veggies=0.0, HeartDiseaseorAttack=1.0)


def row(**over):
    d = dict(HEALTHY)
    d.update(over)
    return tuple(d[c] for c in HEART.columns)


def frame(spark, rows):
    return spark.createDataFrame(rows, HEART.raw_schema)
