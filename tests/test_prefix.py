"""Property tests of the shared plan shapes against pandas / numpy."""

import numpy as np
from hypothesis import given, settings, strategies as st

from churnlake.functions.prefix import exact_quantiles, prefix_sums


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50), st.integers(0, 9)), min_size=1, max_size=60,
                unique_by=lambda t: (t[0], t[1])))
def test_prefix_sums_match_cumsum(spark_session_for_props, rows):
    spark = spark_session_for_props
    df = spark.createDataFrame(rows, "g int, v int, w int")
    small = {(r["g"], r["v"]): r["cum_w"] for r in prefix_sums(df, "v", ["w"], ["g"]).collect()}
    got = {(r["g"], r["v"]): r["cum_w"]
           for r in prefix_sums(df, "v", ["w"], ["g"], rows_per_range=7).collect()}
    assert small == got
    for g in {r[0] for r in rows}:
        acc = 0
        for _, v, w in sorted(r for r in rows if r[0] == g):
            acc += w
            assert got[(g, v)] == acc


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=80))
def test_quantiles_match_numpy(spark_session_for_props, vals):
    spark = spark_session_for_props
    qs = [0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    want = np.percentile(np.array(vals), [q * 100 for q in qs])
    for rows in (10, 10 ** 6):   # several ranges, and one
        got = {r["q"]: r["value"] for r in exact_quantiles(df, "x", qs, rows_per_range=rows).collect()}
        for q, w in zip(qs, want):
            assert abs(got[q] - w) <= 1e-9 * max(1.0, abs(w))


def test_prefix_sums_null_groups_long_keys_and_text_keys(spark_session_for_props):
    """NULL groups, 60-bit integers that are equal as doubles, texts and
    dates, ascending and descending, with one and with many ranges."""
    import datetime as dt
    spark = spark_session_for_props
    base = 1 << 59
    rows = [(None if g == 2 else g, base + v, f"key {chr(97 + v % 26)}{v:03d}", dt.date(2020, 1, 1) + dt.timedelta(days=v), (v * 7 + g) % 5)
            for g in range(3) for v in range(60)]
    df = spark.createDataFrame(rows, "g int, big bigint, name string, day date, w int")
    for order, key in (("big", 1), ("name", 2), ("day", 3)):
        for down in (False, True):
            for per in (9, 10 ** 6):
                got = {(r["g"], r[order]): r["cum_w"] for r in
                       prefix_sums(df, order, ["w"], ["g"], descending=down, rows_per_range=per).collect()}
                for g in (0, 1, None):
                    acc = 0
                    for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[key], reverse=down):
                        acc += r[4]
                        assert got[(g, r[key])] == acc


def test_quantiles_of_a_null_group(spark_session_for_props):
    df = spark_session_for_props.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "g int, x double")
    got = {r["g"]: r["value"] for r in exact_quantiles(df, "x", [0.5], ["g"], rows_per_range=1).collect()}
    assert got == {None: 2.0, 1: 5.0}
