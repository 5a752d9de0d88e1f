import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.operators import bronze
from gaugeline.sources import landing

FULL, SHORT, EMPTY = 3, 1, 0


def kept_by_reader(pages):
    """What a reader asking for page 1, 2, ... keeps; pages: {number: (status, documents)}."""
    kept, number = [], 1
    while number in pages:
        status, documents = pages[number]
        if status != 200 or documents == 0:
            break
        kept.append(number)
        if documents < FULL:
            break
        number += 1
    return kept


def run_prefix(spark, feeds):
    rows = [
        (feed, number, status, [str(i) for i in range(documents)])
        for feed, pages in enumerate(feeds)
        for number, (status, documents) in pages.items()
    ]
    df = spark.createDataFrame(rows, "feed int, page int, status int, results array<string>")
    kept = landing.page_prefix(df, ["feed"], page_limit=FULL).select("feed", "page").collect()
    return sorted((r.feed, r.page) for r in kept)


def expected(feeds):
    return sorted((f, p) for f, pages in enumerate(feeds) for p in kept_by_reader(pages))


def test_page_prefix_cases(spark):
    feeds = [
        {1: (200, FULL), 2: (200, SHORT)},
        {1: (200, FULL), 2: (500, 0), 3: (200, FULL)},  # failure in the middle
        {1: (200, EMPTY), 2: (200, FULL)},  # empty first page
        {1: (200, FULL), 2: (200, EMPTY)},  # exactly one full page
        {1: (200, SHORT), 2: (200, FULL)},  # beyond the first short page
        {1: (200, FULL), 3: (200, FULL)},  # missing page
        {2: (200, FULL)},  # missing first page
        {1: (429, FULL)},
        {1: (200, FULL)},
    ]
    assert run_prefix(spark, feeds) == expected(feeds)


page = st.tuples(st.sampled_from([200, 200, 200, 500]), st.sampled_from([FULL, FULL, SHORT, EMPTY]))
feed = st.dictionaries(st.integers(1, 5), page, max_size=5)


@settings(max_examples=4, deadline=None)
@given(st.lists(feed, min_size=30, max_size=60))
def test_page_prefix_is_what_a_reader_keeps(spark, feeds):
    feeds.append({1: (200, FULL)})
    assert run_prefix(spark, feeds) == expected(feeds)


def test_single_feed(spark, land):
    pages = [{"page": n, "status": 200, "results": [{"id": n}] * 3} for n in range(1, 6)]
    pages[3]["status"] = 503
    random.Random(1).shuffle(pages)
    path = land("one", pages)
    kept = landing.page_prefix(landing.read_location_pages(spark, path), [], page_limit=3)
    assert sorted(r.page for r in kept.collect()) == [1, 2, 3]
    whole = land("two", [{"page": 1, "status": 200, "results": [{"id": 1}] * 3}])
    kept = landing.page_prefix(landing.read_location_pages(spark, whole), [], page_limit=3)
    assert kept.count() == 1


def test_documents_keep_their_text(spark, land):
    lines = [
        '{"sensor_id":1,"page":1,"status":200,"results":[{"value": 1.50,"extra":{"k":"é"}}, null]}',
        '{"sensor_id":2,"page":1,"status":200,"results":[]}',
        '{"sensor_id":3,"page":1,"sta',
    ]
    pages = landing.read_measurement_pages(spark, land("raw", lines))
    rows = bronze.pack_pages(pages).collect()
    assert [(r.sensor_id, r.rows_fetched, r.api_payload) for r in rows] == [
        (1, 2, '[{"value": 1.50,"extra":{"k":"é"}},null]')
    ]


def test_window_is_half_open_and_keeps_undated_documents(spark):
    def document(at):
        return f'{{"period":{{"datetimeFrom":{{"utc":"{at}"}}}}}}'

    times = ["2024-01-01T00:59:59Z", "2024-01-01T01:00:00Z", "2024-01-01T03:59:59+01:00",
             "2024-01-01T03:00:00Z", "soon"]
    df = spark.createDataFrame([([document(t) for t in times] + ["{}"],)], "results array<string>")
    bounds = [F.lit(b).cast("timestamp") for b in ("2024-01-01 01:00:00.4", "2024-01-01 03:00:00.4")]
    (row,) = df.select(landing.within_window(F.col("results"), *bounds).alias("r")).collect()
    assert row.r == [document(times[1]), document(times[2]), document("soon"), "{}"]
