"""Samples that come out the same in any engine."""

from pyspark.sql import functions as F

from tidemark.operators.sampling import sample_stratified, sample_uniform, strata_fractions
from tidemark.plans.strata import levelled_sample
from tidemark.registry import QueryBook, read
from tidemark.registry.aggregates import HASHED
from tidemark.registry.joins import PLACE_RATIOS, places, ratios, seats

book = QueryBook()


@book.query("SMP-1", f"""SELECT event_id, event_type, value FROM events
                         WHERE {HASHED.format(key="CAST(event_id AS VARCHAR)")} < 42949672""")
def uniform_sample(spark, sf_dir):
    return sample_uniform(read(spark, sf_dir, "events").select("event_id", "event_type", "value"),
                          "event_id", 0.01)


FRACTIONS = PLACE_RATIOS.rstrip() + """,
     fractions AS (SELECT capital, (SELECT floor(min(ratio) * 100) / 100 FROM ratios) / ratio AS fraction
                   FROM ratios)
"""


@book.query("SMP-2 AGG-13", FRACTIONS + "SELECT * FROM fractions")
def stratum_fractions(spark, sf_dir):
    return strata_fractions(ratios(spark, sf_dir), "capital", "ratio")


@book.query("SMP-3 SMP-2", FRACTIONS + f"""
SELECT c_custkey AS id, n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN fractions ON capital = n_name
WHERE {HASHED.format(key="CAST(c_custkey AS VARCHAR)")}
      < CAST(floor(least(fraction, 1.0::DOUBLE) * 4294967296::DOUBLE) AS BIGINT)""")
def stratified_sample(spark, sf_dir):
    sample = levelled_sample(places(spark, sf_dir), seats(spark, sf_dir), "place.name", "capital",
                             "seats", "id")
    return sample.select("id", F.col("place.name").alias("name"))


@book.query("SMP-3", f"""SELECT event_id, event_type FROM events
WHERE {HASHED.format(key="CAST(event_id AS VARCHAR)")}
      < CASE event_type WHEN 'click' THEN 429496729 WHEN 'purchase' THEN 2147483648 END""")
def stratified_sample_by_mapping(spark, sf_dir):
    """Fractions as a mapping; types it does not name are left out."""
    events = read(spark, sf_dir, "events").select("event_id", "event_type")
    return sample_stratified(events, "event_type", {"click": 0.1, "purchase": 0.5}, "event_id")
