"""The tests' own diet table and the cases it holds."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nutrilake.session import local_session  # noqa: E402

COLUMNS = ["Person_ID", "Age", "Gender", "Height_cm", "Weight_kg", "BMI", "Activity_Level",
           "Daily_Calorie_Requirement", "Daily_Calorie_Consumed", "Protein_Intake_g", "Carbohydrate_Intake_g",
           "Fat_Intake_g", "Water_Intake_Liters", "Diet_Type", "Health_Status"]

# One person a line: id, age, gender, height, weight, activity, needs, eats, protein, carbohydrate, fat, water,
# diet, status.  Line 6 comes twice; "-" is a missing cell; D-11 eats far too much fat; ages touch 18, 30 and 60.
PEOPLE = """
D-01 52 Female 171.5 74.2 Sedentary 2050 2310 81 266 77 1.4 Mediterranean Overweight
D-02 17 Male 169 58.4 Athlete 3150 3020 171 402 93 3.4 Balanced Healthy
D-03 30 Other 174.5 66.7 Lightly-Active 2260 2195 99 272 66 2.0 Vegan Healthy
D-04 59 Male 181 103.9 Sedentary 2390 3105 142 351 121 1.2 Keto Obese
D-05 18 Female 162.5 45.1 Very-Active 2205 1690 61 214 44 2.6 Vegetarian Underweight
D-06 41 Male 186.5 92.6 Moderately-Active 2610 2875 133 311 102 1.9 High-Protein Overweight
D-06 41 Male 186.5 92.6 Moderately-Active 2610 2875 133 311 102 1.9 High-Protein Overweight
D-07 60 Female 158 61.3 Lightly-Active 1830 1805 73 221 58 2.1 Balanced Healthy
D-08 29 Female 166 - Moderately-Active 2145 2120 92 255 64 2.4 Keto Healthy
D-09 73 Male 170.5 81.8 - 1985 2240 88 247 79 1.6 Balanced Overweight
D-10 36 Other 177 112.4 Sedentary 2470 3290 149 377 131 1.3 High-Protein Obese
D-11 47 Female 164.5 88.7 Sedentary 2010 2790 104 302 940 1.1 Mediterranean Obese
D-12 23 Male 179.5 56.2 Athlete 2980 2340 118 301 62 2.9 Vegan Underweight
D-13 65 Female 160 69.9 Lightly-Active 1795 2065 79 236 - 1.8 Vegetarian Overweight
D-14 34 Male 183 77.5 Very-Active 2840 2790 156 339 88 2.8 Mediterranean Healthy
D-15 26 Female 167.5 63.0 Moderately-Active 2175 2160 96 261 67 2.3 Vegan Healthy
D-16 55 Male 176 87.1 Lightly-Active 2225 2480 109 284 91 1.7 Keto Overweight
"""


def diet_csv() -> str:
    rows = [",".join(COLUMNS)]
    for line in PEOPLE.split("\n"):
        if line:
            cells = ["" if c == "-" else c for c in line.split(" ")]
            for i in (5, 12, 13):
                cells[i] = cells[i].replace("-", " ")
            height, weight = float(cells[3]), cells[4]
            bmi = f"{float(weight) / (height / 100) ** 2:.1f}" if weight else "24.5"
            rows.append(",".join([*cells[:5], bmi, *cells[5:]]))
    return "\n".join(rows) + "\n"


DIET_CSV = diet_csv()

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, "nutrilake-tests")
    yield s


@pytest.fixture(scope="session")
def mock_csv(tmp_path_factory):
    d = tmp_path_factory.mktemp("diet")
    p = d / "people.csv"
    p.write_text(DIET_CSV)
    return str(p)


@pytest.fixture(scope="session")
def mock_df(spark, mock_csv):
    from nutrilake.sources.loader import load_table
    return load_table(spark, mock_csv).cache()


@pytest.fixture(scope="session")
def mock_dedup(spark, mock_csv):
    from nutrilake.operators.clean import drop_duplicates_first
    from nutrilake.sources.loader import read_raw_csv, coerce_numeric
    from pyspark.sql import functions as F
    raw = read_raw_csv(spark, mock_csv).withColumn("_pos", F.monotonically_increasing_id())
    return coerce_numeric(drop_duplicates_first(raw, "Person_ID", ["_pos"]).drop("_pos")).cache()


@pytest.fixture(scope="session")
def published(spark, mock_df, tmp_path_factory):
    """Prepared + compared + published artifacts on the doubled mock table."""
    import os
    from pyspark.sql import functions as F
    from nutrilake.plans import training
    from nutrilake.plans.preprocess import prepare
    out = str(tmp_path_factory.mktemp("models"))
    base = mock_df.unionByName(mock_df.withColumn("Person_ID", F.concat("Person_ID", F.lit("b"))))
    p = prepare(base, test_size=0.25, out_dir=os.path.join(out, "processed"), how="cache")
    res = training.compare_models(p, os.path.join(out, "models"), 42,
                                  {"ovr_gbt": {"n_estimators": 2, "max_depth": 2},
                                   "softmax_boost": {"iterations": 2, "depth": 2}})
    winner = training.publish_best(res, os.path.join(out, "models"))
    return out, winner


