"""Event-time windows against loops and the batch form: late rows, several calls, nothing arrived."""

import datetime as dt
import os

import pytest
from prosewell.operators import opinion, temporal
from prosewell.session import ship
from prosewell.streaming import windows
from prosewell.streaming.running import running_polarity

SCHEMA = "id long, ts timestamp_ntz, by string, value double, start string"
DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else DAY + dt.timedelta(hours=hours)


def arrive(spark, source, rows):
    frame = spark.createDataFrame([(i, at(h), b, v, "clash") for i, h, b, v in rows], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(source)


BATCHES = [
    [(1, 1, "a", 1.0), (2, 2, "a", 2.0), (3, 30, "b", 4.0), (4, None, "a", 9.0)],
    [(5, 3, "a", 8.0), (6, 75, None, None), (7, 31, "b", 1.0)],
    [(8, 4, "a", 16.0), (9, 100, "a", 1.0), (8, 4, "a", 16.0)],
    [(10, 5, "a", 32.0), (11, 32, "b", 2.0), (12, 50, "c", 7.0), (13, 150, "a", 1.0)],
]


def expected(batches, width=24, delay=24):
    """By the rule: late is what ended before the watermark of the batch before its own."""
    marks, top = [], None
    for batch in batches:
        top = max([h for _, h, _, _ in batch if h is not None] + ([] if top is None else [top]))
        marks.append(top - delay)
    found = {}
    for k, batch in enumerate(batches):
        for _, h, by, v in batch:
            if h is None:
                continue
            start = h // width * width
            arrived, n, total = found.get((start, by), (0, 0, None))
            if k < 2 or start + width > marks[k - 2]:
                n, total = n + 1, total if v is None else (total or 0) + v
            found[start, by] = arrived + 1, n, total
    last = max(s for (s, _), (_, n, _) in found.items() if n and s + width <= marks[-1])
    return {
        (at(s), by, arrived, n if s <= last else None, (total or 0.0) if s <= last else None,
         arrived - n if s <= last else 0, s <= last)
        for (s, by), (arrived, n, total) in found.items()
    }


def test_late_rows_are_counted(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    args = spark, source, SCHEMA, target, "ts", "by", "value", "1 day", "1 day", 1
    assert windows.tumbling_windows(*args).count() == 0
    os.makedirs(source)
    assert windows.tumbling_windows(*args).count() == 0
    for batch in BATCHES:
        arrive(spark, source, batch)
    found = windows.tumbling_windows(*args).collect()
    columns = ["start", "by", "arrived", "rows", "total", "late", "closed"]
    assert {tuple(r[c] for c in columns) for r in found} == expected(BATCHES)
    assert sum(r.late for r in found) > 0 and any(not r.closed for r in found)
    # Nothing new: the same table. One more file: old counts stay, and no row is lost.
    assert sorted(windows.tumbling_windows(*args).collect(), key=str) == sorted(found, key=str)
    more = [(14, 6, "a", 64.0), (15, 300, "a", 1.0)]
    arrive(spark, source, more)
    again = windows.tumbling_windows(*args).collect()
    assert sum(r.arrived for r in again) == sum(len(b) for b in BATCHES) - 1 + len(more)
    before = {(r.start, r.by): (r.rows, r.total) for r in found if r.closed}
    after = {(r.start, r.by): (r.rows, r.total) for r in again}
    assert before.items() <= after.items()
    assert all(r.arrived == r.rows + r.late for r in again if r.closed)


def test_closed_windows_equal_the_batch(spark, folder, tmp_path):
    """Rows in order of time, in seven files: nothing is late, and what is closed equals one query over all rows."""
    rows = spark.read.parquet(f"{folder}/events.parquet").select("ts", "user_id", "event_type", "value")
    source = str(tmp_path / "in")
    for k in range(7):
        rows.filter(f"(dayofmonth(ts) - 1) div 5 = {k}").coalesce(1).write.mode("append").parquet(source)
    schema = "ts timestamp_ntz, user_id bigint, event_type string, value double"
    found = windows.tumbling_windows(
        spark, source, schema, str(tmp_path / "w"), "ts", "event_type", "value", "6 hours", "1 hour", 1
    ).filter("closed")
    whole = rows.selectExpr("window(ts, '6 hours').start AS s", "event_type").groupBy("s", "event_type").count()
    wanted = {(r.s, r.event_type): r["count"] for r in whole.collect()}
    got = {(r.start, r.event_type): r.rows for r in found.collect()}
    assert got.items() <= wanted.items() and len(got) > 0.9 * len(wanted)
    assert found.filter("late > 0").count() == 0

    hours = 3_600_000_000
    gap = 8 * hours
    closed = windows.session_windows(
        spark, source, schema, str(tmp_path / "s"), "ts", "user_id", "value", "8 hours", "1 hour", 1
    )
    got = {(r.user_id, r.start, r.end - dt.timedelta(hours=8)): r.rows for r in closed.collect()}
    whole = temporal.sessions(rows, "user_id", "ts", gap - 1)
    wanted = {(r.user_id, r.start, r.end): r.events for r in whole.collect()}
    assert got.items() <= wanted.items()
    last = max(r[1] for r in wanted)
    assert len(got) >= len([r for r in wanted if r[2] < last - dt.timedelta(days=1)])


TURNS = "conv_id long, turn long, text string"
WORDS = [("good", 1), ("bad", -1), ("mixed", 1), ("mixed", -1)]


def plain_totals(turns):
    out = {}
    for conv, _, text in turns:
        words = (text or "").split()
        pos = sum(w in ("good", "mixed") for w in words)
        neg = sum(w in ("bad", "mixed") for w in words)
        was = out.get(conv, (0, 0, 0, 0))
        out[conv] = tuple(a + b for a, b in zip(was, (1, len(words), pos, neg), strict=True))
    return out


@pytest.mark.parametrize("limit", [opinion.INLINE_WORDS, 1])
def test_running_polarity_resumes_and_expires(spark, tmp_path, monkeypatch, limit):
    """Three calls over growing input equal the batch after each; state idle for long is dropped, its counts are not."""
    monkeypatch.setattr(opinion.inline_words, "__defaults__", (limit,))
    ship(spark)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    lexicon = spark.createDataFrame(WORDS, "word string, polarity int")
    # Conversation 0 has a third of all turns.
    turns = [(0 if i % 3 == 0 else i % 7, i, ["good day", "bad mixed bad", None, "", "good good"][i % 5]) for i in range(60)]
    turns += [(None, 1, "good"), (None, 1, "good"), (3, 5, "bad")]

    def run(idle_ms):
        totals, history = running_polarity(
            spark, source, TURNS, lexicon, target, "conv_id", idle_ms=idle_ms, files_per_batch=1
        )
        columns = ["docs", "tokens", "pos", "neg"]
        rows = totals.collect()
        assert all(r.net == r.pos - r.neg for r in rows)
        return {r.conv_id: tuple(r[c] for c in columns) for r in rows}, {r.conv_id: r.episodes for r in rows}, history

    assert run(60_000)[0] == {}
    for k in range(2):
        spark.createDataFrame(turns[k::4], TURNS).coalesce(1).write.mode("append").parquet(source)
    found, episodes, history = run(60_000)
    assert found == plain_totals(turns[0::4] + turns[1::4]) and history.filter("expired").count() == 0
    spark.createDataFrame(turns[2::4], TURNS).coalesce(1).write.mode("append").parquet(source)
    found, episodes, history = run(1)
    assert found == plain_totals(turns[0::4] + turns[1::4] + turns[2::4])
    # State that was set idle after a millisecond has expired by the next batch, and begins anew.
    spark.createDataFrame(turns[3::4], TURNS).coalesce(1).write.mode("append").parquet(source)
    found, episodes, history = run(1)
    assert found == plain_totals(turns) and max(episodes.values()) > 1
    assert history.filter("expired").count() > 0
    # A conversation's history only grows within an episode.
    steps = {}
    for r in history.collect():
        steps.setdefault((r.conv_id, r._slice, r.since), []).append((r.version, r.docs, r.tokens))
    for some in steps.values():
        some.sort()
        assert all(a[0] < b[0] and a[1] <= b[1] and a[2] <= b[2] for a, b in zip(some, some[1:], strict=False))
