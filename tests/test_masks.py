import pytest
from pyspark.sql import functions as F

from tidemark.functions import masks

# (mask, file name, fits)
CASES = [
    # 1: date and time, exact and glob
    ("a_YYYYMMDDHHMMSS.csv", "a_20240131235959.csv", True),
    ("a_YYYYMMDDHHMMSS.csv", "a_20240131245959.csv", False),
    ("a_YYYYMMDDHHMMSS.csv", "b_20240131235959.csv", False),
    ("a_YYYYMMDDHHMMSS.csv", "a_20240131235959.csv.gz", False),
    ("*YYYYMMDDHHMMSS.csv", "x_20240131000000.csv", True),
    ("*YYYYMMDDHHMMSS.csv", "x_20241331000000.csv", False),
    # 2: no length check in exact mode
    ("a_YYYYMMDD_HHMMSS.csv", "xx_a_20240131_999999.csv", True),
    ("a_YYYYMMDD_HHMMSS.csv", "a_20240132_000000.csv", False),
    ("a_YYYYMMDD_HHMMSS*", "a_20240131_000000_v2.csv", True),
    # 3
    ("a_YYYY-MM-DD.csv", "a_2024-02-29.csv", True),
    ("a_YYYY-MM-DD.csv", "a_2024-2-29.csv", False),
    ("*YYYY-MM-DD.csv", "a_2024-02-29.csv", True),
    ("*YYYY-MM-DD.csv", "a_2024-02-29.txt", False),
    # 4: glob ignores the rest of the mask, exact wants length and prefix
    ("a_MMYYYY.csv", "a_122024.csv", True),
    ("a_MMYYYY.csv", "b_122024.csv", False),
    ("a_MMYYYY.csv", "a_132024.csv", False),
    ("other_MMYYYY*", "a_122024.csv", True),
    # 5
    ("a_YYYYMMDD.csv", "a_20240131.csv", True),
    ("a_YYYYMMDD.csv", "a_20240132.csv", False),
    ("a_YYYYMMDD.csv", "a_20240131.txt", False),
    ("a_YYYYMMDD.csv", "aa_20240131.csv", False),
    ("a_YYYYMMDD*", "zz_a_20240131.csv", True),
    # 6: prefix in both modes
    ("a_YYYYMM.csv", "a_202412.csv", True),
    ("a_YYYYMM.csv", "a_202413.csv", False),
    ("a_YYYYMM.csv", "b_202412.csv", False),
    ("a_YYYYMM*", "a_202412_v2.csv", True),
    ("a_YYYYMM*", "b_a_202412.csv", False),
    # 7
    ("a_MM-DD-YYYY.csv", "a_12-31-2024.csv", True),
    ("a_MM-DD-YYYY.csv", "a_31-12-2024.csv", False),
    ("*MM-DD-YYYY*", "a_12-31-2024", True),
    # 8
    ("a_DDMONYYYY.csv", "a_31DEC2024.csv", True),
    ("a_DDMONYYYY.csv", "a_31Dec2024.csv", False),
    ("a_DDMONYYYY*", "a_01JAN2024_x.csv", True),
    # 9
    ("a_YYYY_MM_DD_######.csv", "a_2024_12_31_000123.csv", True),
    ("a_YYYY_MM_DD_######.csv", "a_2024_12_31_00123.csv", False),
    ("*YYYY_MM_DD_######.csv", "long_2024_12_31_000123.csv", True),
    # 10
    ("a_YYYYQ#.csv", "a_2024Q4.csv", True),
    ("a_YYYYQ#.csv", "a_2024Q5.csv", False),
    ("*YYYYQ#.csv", "a_2024Q1.csv", True),
    # 11
    ("a_YYYYQ.csv", "a_20244.csv", True),
    ("a_YYYYQ.csv", "a_20245.csv", False),
    ("a_YYYYQ*", "a_20241_x.csv", True),
    # 12: a lone N is a digit; a word that ends in N is just a word
    ("N_YYYYMM.csv", "3_202412.csv", True),
    ("N_YYYYMM.csv", "33_202412.csv", False),
    ("N_YYYYMM.csv", "N_202412.csv", True),
    ("N_YYYYMM*", "7_202401_x.csv", True),
    ("PLAN_YYYYMM.csv", "PLAN_202412.csv", True),
    ("PLAN_YYYYMM.csv", "PLA3_202412.csv", False),
    # 13
    ("a_YYYY.csv", "a_2024.csv", True),
    ("a_YYYY.csv", "b_2024.csv", False),
    ("a_YYYY*", "anything_2024.csv", True),
    ("a_YYYY*", "anything.csv", False),
    # 14: plain regular expressions
    ("orders_[0-9]+", "orders_12.csv", True),
    ("orders_[0-9]+", "my_orders_12.csv", False),
    ("*.csv", "any.csv", True),
    ("*.csv", "any.txt", False),
    ("*.csv", "README", False),
    ("orders*", "old_orders.csv", True),
    ("", "whatever.bin", True),
    (None, "whatever.bin", True),
]


def test_every_mask(spark):
    frames = [
        spark.createDataFrame([(str(mask), name, fits)], "mask string, name string, fits boolean").select(
            "*", masks.mask_matches(F.col("name"), mask).alias("got")
        )
        for mask, name, fits in CASES
    ]
    from functools import reduce

    wrong = reduce(lambda a, b: a.union(b), frames).where("got IS DISTINCT FROM fits").collect()
    assert wrong == []


@pytest.mark.parametrize(
    "name, fits", [("w_202453.csv", True), ("w_202454.csv", False), ("w_202453.csvx", False), ("x_202401.csv", True)]
)
def test_custom_mask(spark, name, fits):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.where(masks.custom_mask_matches(F.col("name"), "w_YYYYWW.csv")).count() == int(fits)
    assert df.where(masks.custom_mask_matches(F.col("name"), "w_UNKNOWN.csv")).count() == 0


def test_illegal_characters(spark):
    names = [f"a{c}b.csv" for c in "@!%^&*<>?/\\|}{~:"]
    df = spark.createDataFrame([(n,) for n in [*names, "ok-file_1 (x)#.csv"]], "name string")
    assert [r.name for r in df.where(masks.legal_name(F.col("name"))).collect()] == ["ok-file_1 (x)#.csv"]
