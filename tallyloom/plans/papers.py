"""Paper and patent statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import first_year
from tallyloom.functions.text import split_list
from tallyloom.operators.groups import count_if_matrix, rollup_levels


def paper_bands() -> dict[str, Column]:
    """Citation and impact bands; impact is compared as a number, not as text."""
    cited, impact = F.col("citations"), F.col("impact").try_cast("double")
    return {
        "n_papers": F.lit(True),
        "cited_0_9": (cited >= 0) & (cited < 10), "cited_10_49": (cited >= 10) & (cited < 50),
        "cited_50_99": (cited >= 50) & (cited < 100), "cited_100_up": cited >= 100,
        "impact_0_1": (impact >= 0) & (impact < 2), "impact_2": (impact >= 2) & (impact < 3),
        "impact_3_4": (impact >= 3) & (impact < 5), "impact_5_up": impact >= 5,
    }


def paper_stats_by_year(papers: DataFrame) -> DataFrame:
    """Distinct titles per year of publication in every band (papers: title, published, ...)."""
    dated = papers.filter(F.col("published").isNotNull()).withColumn("year", F.substring("published", 1, 4))
    return count_if_matrix(dated, ["year"], paper_bands(), "title")


def paper_stats_by_unit(papers: DataFrame, levels: Sequence[str], index_codes: Mapping[str, str],
                        top_journals: Sequence[str]) -> DataFrame:
    """Distinct titles per level of the hierarchy: all, per index class, in top journals.

    `index_codes` maps a measure to a code looked for in the comma list `index_codes`.
    """
    listed = papers.withColumn("_codes", split_list("index_codes"))
    measures = {"n_papers": F.lit(True)}
    measures |= {name: F.array_contains("_codes", code) for name, code in index_codes.items()}
    measures["n_top"] = F.col("journal").isin(*top_journals)
    return rollup_levels(listed, levels, {}, measures, "title")


def patent_stats(patents: DataFrame, international: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Distinct patents by year granted (or applied, or 0) and kind, plus an international source.

    patents: title, kind, granted, applied; international: title, applied.
    """
    dated = patents.withColumn("year", first_year("granted", "applied"))
    measures = {name: F.col("kind") == code for name, code in kinds.items()}
    measures["n_other"] = ~F.col("kind").isin(*kinds.values())
    measures["n_domestic"] = F.lit(True)
    own = count_if_matrix(dated, ["year"], measures, "title")
    other = (international.groupBy(F.substring("applied", 1, 4).alias("year"))
             .agg(F.count_distinct("title").alias("n_international")))
    joined = own.join(other, "year", "left").withColumn("n_international", F.coalesce("n_international", F.lit(0)))
    return joined.withColumn("n_total", F.col("n_domestic") + F.col("n_international"))
