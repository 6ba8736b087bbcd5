"""Hand-made layoffs sample (FIXTURES.md section 1.1) with expected results."""

from scrubline.schemas import LAYOFFS_RAW

RAW_ROWS = [
    ("Acme", "Austin", "Retail", 100, "0.5", "3/6/2023", "Series B", "United States", 50),
    ("Acme", "Austin", "Retail", 100, "0.5", "3/6/2023", "Series B", "United States", 50),
    (" Acme", "Austin", "Retail", 100, "0.5", "3/6/2023", "Series B", "United States", 50),
    ("Acme", "Austin", "", 20, None, "12/16/2022", "Series B", "United States.", 50),
    ("Coinly", "Paris", "CryptoCurrency", 30, "1", "01/02/2022", "Seed", "France.", 5),
    ("Coinly", "Paris", "Crypto Currency", None, "1.0", "11/30/2022", "Seed", "France", None),
    ("Solo", "Oslo", None, None, "0.25", None, None, "Norway", 7),
    ("Ghost", "Rome", "Travel", None, None, "5/5/2021", "IPO", "Italy", 9),
    (None, "Lima", None, 8, None, "2/30/2023", "Seed", "Peru", 1),
    (None, "Lima", "Food", 9, "", "7/1/2021", "Seed", "Peru", 1),
]


def raw_df(spark):
    return spark.createDataFrame(RAW_ROWS, LAYOFFS_RAW)
