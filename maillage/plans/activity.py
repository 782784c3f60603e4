"""Activity records: by territory and month, by topic, by kind of beneficiary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.functions import departement_of_insee, periode_of_date
from maillage.operators.aggregates import explode_count, sum_json_counts

# Groups of counters in the beneficiaries column.
BENEFICIARY_GROUPS = ("genres", "tranches_age", "statuts")


def activites_par_territoire_periode(activites: DataFrame) -> DataFrame:
    """Activities, minutes and accompaniments per department of the place and month."""
    return activites.groupBy(
        departement_of_insee(F.col("lieu_code_insee")).alias("departement_code"), periode_of_date(F.col("date")).alias("periode")
    ).agg(
        F.count("*").alias("nb_activites"),
        F.sum("duree").alias("minutes"),
        F.sum("accompagnements").alias("accompagnements"),
    )


def activites_par_thematique(activites: DataFrame, topics: str | Column = "thematiques") -> DataFrame:
    return explode_count(activites, topics, alias="thematique").withColumnRenamed("nb", "nb_activites")


def beneficiaires_totaux(activites: DataFrame, json: str = "beneficiaires") -> DataFrame:
    return sum_json_counts(activites, json, BENEFICIARY_GROUPS)
