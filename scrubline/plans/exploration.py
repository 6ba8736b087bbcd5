"""J-2: the exploration queries over a cleaned table, as named DataFrames.

Each entry is lazy; nothing is collected. Column names follow the original
queries (``total_laid_off``, ``total_off``, ``rolling_total``, ``ranking``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analysis as A


def explore(clean: DataFrame, *, company: str = "company", industry: str = "industry",
            stage: str = "stage", date: str = "date", measure: str = "total_laid_off",
            pct: str = "percentage_laid_off", funds: str = "funds_raised_millions",
            top_n: int = 5) -> dict[str, DataFrame]:
    by_month = A.total_by_period(clean, date, measure, period="month", out="total_off",
                                 sort="asc")
    company_year = A.total_by_period(clean, date, measure, period="year", keys=[company],
                                     out=measure)
    return {
        "all_rows": clean,
        "full_layoffs": A.numeric_text_equals(clean, pct, 1.0, order_by=funds),
        "total_by_company": A.total_by(clean, company, measure, out=measure),
        "date_span": A.date_span(clean, date),
        "total_by_industry": A.total_by(clean, industry, measure, out=measure),
        "total_by_year": A.total_by(clean, F.year(date).alias("year"), measure, out=measure),
        "total_by_stage": A.total_by(clean, stage, measure, out=measure),
        "total_by_month": by_month.withColumnRenamed("total_off", measure),
        "rolling_total": A.running_total(by_month, "month", "total_off", unique_order=True)
                          .orderBy("month"),
        "total_by_company_year": company_year.orderBy(F.col(measure).desc()),
        "top_companies_per_year": A.top_n_per_group(company_year, "year", measure, n=top_n),
    }
