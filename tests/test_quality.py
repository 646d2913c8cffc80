from fractions import Fraction

from hypothesis import HealthCheck, given as hypothesis_given, settings, strategies as st
from pyspark.sql import functions as F

from timberline.functions.labels import rounded
from timberline.operators.quality import top_k_quality

ROWS = "query_id bigint, rank bigint, event_id string, similarity double"


def test_known_report(spark):
    rows = spark.createDataFrame([(1, 1, "E1", 0.9), (1, 2, "E1", 0.8), (1, 3, "E2", 0.7)], ROWS)
    row = top_k_quality(rows).first()
    assert (row.score, row.average_similarity, row.dominant_event_id) == (0.7533, 0.8, "E1")
    assert (row.dominant_event_share, row.distinct_events, row.result_count) == (0.6667, 2, 3)


def test_empty_result_reports_zeros(spark):
    queries = spark.createDataFrame([(7,)], "query_id bigint")
    row = top_k_quality(spark.createDataFrame([], ROWS), queries).first()
    assert (row.score, row.result_count, row.dominant_event_id, row.distinct_events) == (0.0, 0, None, 0)
    assert row.method == "proxy_similarity_event_concentration"


def test_ties_unknown_events_and_missing_similarities(spark):
    rows = [(1, 1, "B", None), (1, 2, "A", 0.5), (1, 3, "A", 0.5), (1, 4, "B", None), (2, 1, "", None), (2, 2, None, None)]
    report = {row.query_id: row for row in top_k_quality(spark.createDataFrame(rows, ROWS)).collect()}
    assert report[1].dominant_event_id == "B"
    assert report[1].average_similarity == 0.5
    assert (report[2].dominant_event_id, report[2].average_similarity) == ("UNKNOWN", 0.0)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@hypothesis_given(
    st.lists(
        st.one_of(
            st.floats(-1, 1, allow_nan=False),
            st.integers(-20000, 20000).map(lambda n: n / 20000),
            st.integers(-64, 64).map(lambda n: n / 64),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_scores_round_as_python_does(spark, values):
    table = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = [row[0] for row in table.select(rounded(F.col("x"), 4)).collect()]
    assert found == [round(float(v), 4) for v in values]


def test_rounding_at_decimal_halves(spark):
    values = [n / 100000 for n in range(5, 100000, 10)]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    found = [row[0] for row in table.coalesce(1).select(rounded(F.col("x"), 4)).collect()]
    assert found == [round(v, 4) for v in values]
    # Both directions occur, so neither half-up nor half-even on the digits would do.
    ups = [Fraction(f) > Fraction(v) for f, v in zip(found, values)]
    assert any(ups) and not all(ups)
