"""Streams over file sources with ``availableNow`` triggers, so that every test ends."""

import datetime as dt
import tempfile


import pyarrow.parquet as pq
import pytest

from footlights.streaming import streams


@pytest.fixture(autouse=True)
def one_partition(spark):
    """State stores are per partition; one is enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def drain(df, mode="append"):
    """Run a stream to its end into memory and return its rows."""
    name = f"t{abs(hash(df)) % 10**9}"
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", tempfile.mkdtemp()).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return df.sparkSession.table(name).collect()


def files(spark, batches, schema):
    """A stream of one Parquet file a batch, in order."""
    import os
    import time

    folder = tempfile.mkdtemp()
    for k, rows in enumerate(batches):
        path = f"{folder}/{k}.parquet"
        pq.write_table(spark.createDataFrame(rows, schema).toArrow(), path, coerce_timestamps="us")
        os.utime(path, (time.time() - 100 + k, time.time() - 100 + k))
    return streams.read_stream(spark, folder, schema)


def at(day, hour=0, minute=0):
    return dt.datetime(2026, 1, day, hour, minute)


def test_staging_is_idempotent(spark):
    s = files(spark, [[("a", at(1)), ("b", at(1))], [("a", at(1, 1)), ("c", at(2))]], "dedupe_key string, scraped_at timestamp")
    assert sorted(r.dedupe_key for r in drain(streams.stream_stage(s))) == ["a", "b", "c"]


@pytest.fixture()
def stateful(spark):
    """A session with the state store that processors need, one partition."""
    own = streams.stateful_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", "1")
    return own


REQUESTS = "month string, at timestamp, run_id string, amount long"


def test_ledger_refuses_and_keeps_its_sum(stateful):
    """The second file comes late, yet its request goes by its time; the last row only moves the watermark."""
    s = files(stateful, [[("2026-01", at(2), "r", 60), ("2026-01", at(3), "q", 40)], [("2026-01", at(1), "r", 60), ("2026-02", at(3), "r", 10)], [("2026-09", at(9), "r", 1)]], REQUESTS)
    got = sorted((r.month, r.at, r.ok, r.month_sum) for r in drain(streams.stream_ledger(s, 100, 100, late="3 days")))
    assert got == [("2026-01", at(1), True, 60), ("2026-01", at(2), False, 60), ("2026-01", at(3), True, 100), ("2026-02", at(3), True, 10)]


def test_ledger_forgets_a_month(stateful):
    """40 days after a month's last request its sums are gone: a request of that month starts anew."""
    later = dt.datetime(2026, 3, 20)
    s = files(stateful, [[("m", at(1), "r", 100)], [("x", later, "r", 1)], [("m", later, "r", 100)], [("x", later + dt.timedelta(days=2), "r", 1)]], REQUESTS)
    assert [(r.at, r.ok) for r in sorted(drain(streams.stream_ledger(s, 100, 100))) if r.month == "m"] == [(at(1), True), (later, True)]


def test_ledger_goes_on_from_its_checkpoint(stateful, tmp_path):
    """Stopped after a file and started again, a stream gives what one run over all files gives."""
    import os
    import shutil
    import time

    batches = [[("m", at(d, h), f"r{(d * h) % 3}", 10 * (d + h) % 70) for h in (1, 5, 9)] for d in range(1, 7)] + [[("z", at(20), "r", 1)]]
    whole = sorted(drain(streams.stream_ledger(files(stateful, batches, REQUESTS), 150, 80)))
    source, given, out, state = (tmp_path / n for n in ("source", "given", "out", "state"))
    for folder in (source, given):
        folder.mkdir()
    for k, rows in enumerate(batches):
        pq.write_table(stateful.createDataFrame(rows, REQUESTS).toArrow(), given / f"{k}.parquet", coerce_timestamps="us")
    for first, last in ((0, 4), (4, 7)):
        for k in range(first, last):
            shutil.copy(given / f"{k}.parquet", source / f"{k}.parquet")
            os.utime(source / f"{k}.parquet", (time.time() - 100 + k, time.time() - 100 + k))
        rows = streams.stream_ledger(streams.read_stream(stateful, str(source), REQUESTS), 150, 80)
        q = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(state)).start(str(out))
        q.awaitTermination(120)
        assert q.exception() is None
    assert sorted(stateful.read.schema(rows.schema).parquet(str(out)).collect()) == whole
    assert {r.ok for r in whole} == {True, False}


def test_changes(stateful):
    s = files(stateful, [[("u", "l", "h1", at(1))], [("u", "l", "h1", at(2)), ("v", "l", "h", at(2))], [("u", "l", "h2", at(3))], [("w", "l", "h", at(9))]], "url string, role string, text_hash string, at timestamp")
    got = sorted((r.url, r.at, r.state) for r in drain(streams.stream_changes(s)))
    assert [x[2] for x in got] == ["new", "unchanged", "changed", "new"]


def test_changes_after_days(stateful):
    """An equal page is read again when its reading is older than ``days``; a null hash is a hash of its own."""
    s = files(stateful, [[("u", "l", "h", at(1)), ("u", "l", "h", at(3)), ("u", "l", "h", at(4)), ("n", "l", None, at(1)), ("n", "l", "h", at(1)), ("n", "l", None, None)], [("w", "l", "h", at(9))]], "url string, role string, text_hash string, at timestamp")
    assert [r.state for r in sorted(drain(streams.stream_changes(s, days=1))) if r.url == "u"] == ["new", "expired", "unchanged"]


def test_stalls_close_spells(spark):
    s = files(spark, [[("j", at(1, 0, 0)), ("j", at(1, 0, 10))], [("j", at(1, 2, 0))], [("j", at(2))]], "job string, at timestamp")
    got = sorted((r.started, r.n) for r in drain(streams.stream_stalls(s)))
    assert [n for _, n in got][:2] == [2, 1]


def test_answered_sources(stateful):
    s = files(stateful, [[("s", at(1), 1), ("s", at(1), 1)], [("s", at(2), -1)], [("s", at(3), -1), ("t", at(3), -1), ("t", at(3), 1)], [("x", at(9), 1)]], "source_id string, at timestamp, delta int")
    assert sorted((r.source_id, r.at) for r in drain(streams.stream_save_when_answered(s))) == [("s", at(3)), ("t", at(3))]


def test_late_answers(spark):
    asked = files(spark, [[("b", "1", at(1), 0.5), ("b", "2", at(1), 0.5)]], "batch_id string, custom_id string, sent_at timestamp, estimate double")
    told = files(spark, [[("b", "1", at(3), "succeeded")]], "batch string, custom string, answered_at timestamp, result string")
    assert [(r.custom_id, r.result) for r in drain(streams.stream_pending(asked, told)) if r.result] == [("1", "succeeded")]


def test_refresh_only_touched_evenings(spark):
    from pyspark.sql import functions as F

    from footlights.operators.groups import header_flags

    seen = []
    rows = spark.createDataFrame([("1", "e1"), ("2", "e1"), ("3", "e2"), ("4", "e2")], "id string, ek string")
    text = ("ptitle", "program_title", "work_id", "choreographer_id", "choreographer_kind", "ticket_url", "image_url", "description", "company_id", "credit_line", "member_names", "work_title")
    rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in text], F.lit(None).cast("int").alias("program_position"), F.array().cast("array<string>").alias("member_ids"), F.lit(at(1)).alias("starts_at"), F.lit(at(1)).alias("created_at"), F.lit(False).alias("cancelled"), F.array().cast("array<string>").alias("tags"), F.array().cast("array<string>").alias("editorial"))
    changes = files(spark, [[("e1", None)], [("e1", "e2")]], "old_key string, new_key string")
    load = lambda keys: header_flags(rows).join(keys, "ek", "left_semi")
    q = streams.stream_refresh_groups(changes, load, lambda df, n: seen.append(sorted(r.ek for r in df.collect()))).option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert seen == [["e1"], ["e1", "e2"]]


def test_batch_stalls(spark):
    df = spark.createDataFrame([("j", at(1, 0)), ("j", at(1, 2)), ("j", at(1, 2, 20))], "job string, at timestamp")
    assert [(r.since, r.until) for r in streams.stalls(df).collect()] == [(at(1, 0), at(1, 2))]
