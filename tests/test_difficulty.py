"""Attempts, weekly board difficulty and board migration."""

import datetime as dt
import random

from raw_events import BASE, raw_event

from playmetrics.operators.difficulty import (
    OUTCOMES,
    START,
    attempts,
    board_difficulty_weekly,
    board_migration_weekly,
)
from playmetrics.operators.staging import stage_events

S = dt.timedelta(seconds=1)
W = dt.timedelta(days=7)
EVENT = dict(OUTCOMES, start=START, end="level_end_quickplay")


def play(user, board, at, what):
    return raw_event(user=user, at=at, name=EVENT[what], params={"board": ("string_value", board)})


def tried(spark, make_raw, rows, **options):
    out = attempts(stage_events(make_raw(rows)), **options)
    return sorted((r.user_pseudo_id, r.board, int((r.event_at - BASE.replace(tzinfo=None))
                                                  .total_seconds()), r.outcome, r.seconds)
                  for r in out.collect())


def test_a_start_takes_the_first_outcome_before_the_next_start(spark, make_raw):
    rows = [play("a", "S", BASE + t * S, what) for t, what in [
        (0, "completed"), (1, "start"), (2, "end"), (5, "failed"), (6, "completed"),
        (7, "start"), (9, "start"), (12, "retried"), (20, "start")]]
    rows += [play("a", "L", BASE + 3 * S, "start"), play("b", "S", BASE + 4 * S, "start"),
             play("a", "L", BASE + 9 * S, "reset")]
    assert tried(spark, make_raw, rows) == [
        ("a", "L", 3, "reset", 6), ("a", "S", 1, "failed", 4), ("a", "S", 7, "unfinished", None),
        ("a", "S", 9, "retried", 3), ("a", "S", 20, "unfinished", None),
        ("b", "S", 4, "unfinished", None)]


def test_ties_whole_seconds_and_other_days(spark, make_raw):
    ms = dt.timedelta(milliseconds=1)
    rows = [play("a", "M", BASE, "start"), play("a", "M", BASE, "completed"),  # not its outcome
            play("a", "M", BASE + 3 * W + 1999 * ms, "retried"),
            play("a", "M", BASE + 3 * W + 1999 * ms, "failed"),  # equal times: the lesser name
            play("b", "M", BASE, "start"), play("b", "M", BASE + 1999 * ms, "reset")]
    assert tried(spark, make_raw, rows) == [
        ("a", "M", 0, "failed", int(3 * W.total_seconds()) + 1), ("b", "M", 0, "reset", 1)]


def test_starts_without_time_or_user_are_unfinished(spark, make_raw):
    rows = [play(None, "S", BASE, "start"), play(None, "S", BASE + S, "completed"),
            play("a", "S", None, "start"), play("a", "S", None, "completed"),
            raw_event(user="a", at=BASE, name=START)]  # no board
    out = attempts(stage_events(make_raw(rows))).collect()
    assert sorted((r.user_pseudo_id or "", r.outcome) for r in out) == [
        ("", "unfinished"), ("a", "unfinished")]
    weekly = board_difficulty_weekly(attempts(stage_events(make_raw(rows)))).collect()
    assert [(r.players, r.attempts, r.unfinished, r.completion_rate) for r in weekly] == [
        (1, 2, 2, 0.0)]
    assert board_migration_weekly(attempts(stage_events(make_raw(rows)))).count() == 0


def plain(rows):
    """rows: (user, board, second, what); one attempt per start, by looking at every event."""
    rank = {"completed": 0, "failed": 1, "reset": 2, "retried": 3, "start": 4}
    out = []
    for user, board in {(u, b) for u, b, _, _ in rows}:
        mine = sorted((t, rank[w], w) for u, b, t, w in rows if (u, b) == (user, board))
        for i, (t, _, w) in enumerate(mine):
            if w == "start":
                after = mine[i + 1][2:] + mine[i + 1][:1] if i + 1 < len(mine) else ("start", 0)
                ended = after[0] != "start"
                out.append((user, board, t, after[0] if ended else "unfinished",
                            after[1] - t if ended else None))
    return sorted(out, key=lambda r: (r[:4], r[4] or 0))


def test_buckets_and_hot_users_change_nothing(spark, make_raw):
    rng = random.Random(5)
    rows = sorted({(rng.choice(["hot", "hot", "u1", "u2"]), rng.choice("SML"),
                    rng.randrange(0, 4000), rng.choice(["start", "start", *OUTCOMES]))
                   for _ in range(600)})
    raw = [play(u, b, BASE + t * S, w) for u, b, t, w in rows]
    hot = spark.createDataFrame([("hot",)], "user_pseudo_id string")
    for options in ({}, {"bucket_seconds": 60}, {"hot_users": hot, "hot_bucket_seconds": 7}):
        got = sorted(tried(spark, make_raw, raw, **options), key=lambda r: (r[:4], r[4] or 0))
        assert got == plain(rows)


def test_weekly_tables(spark, make_raw):
    rows = [play("a", "L", BASE, "start"), play("a", "L", BASE + S, "failed"),
            play("a", "S", BASE + 2 * S, "start"), play("a", "S", BASE + 3 * S, "completed"),
            play("b", "L", BASE, "start"), play("b", "L", BASE + 5 * S, "completed"),
            play("a", "S", BASE + W, "start"), play("a", "S", BASE + W + S, "retried"),
            play("b", "L", BASE + 2 * W, "start"),
            play("c", "S", BASE + W, "start"), play("c", "S", BASE + W + 4 * S, "completed")]
    tries = attempts(stage_events(make_raw(rows)))
    monday = BASE.date() - dt.timedelta(days=BASE.weekday())
    week = {(r.week, r.board): r for r in board_difficulty_weekly(tries).collect()}
    large = week[monday, "L"]
    assert (large.players, large.attempts, large.completed, large.failed) == (2, 2, 1, 1)
    assert (large.completion_rate, large.seconds_to_complete) == (0.5, 5.0)
    assert week[monday + 2 * W, "L"].completion_rate_change == -0.5  # its last week, not the last week
    small = week[monday + W, "S"]
    assert (small.completion_rate, small.completion_rate_change, small.retry_reset_rate) == (
        0.5, -0.5, 0.5)
    moved = {(r.first_board, r.week, r.board): (r.players, r.active_players, r.player_share)
             for r in board_migration_weekly(tries).collect()}
    assert moved == {
        ("L", monday, "L"): (2, 2, 1.0), ("L", monday, "S"): (1, 2, 0.5),
        ("L", monday + W, "S"): (1, 1, 1.0), ("S", monday + W, "S"): (1, 1, 1.0),
        ("L", monday + 2 * W, "L"): (1, 1, 1.0)}


def test_events_are_paired_without_a_user_wide_sort(spark, make_raw):
    """The per-user window only sees the summary: no sort of events by user and board alone."""
    plan = attempts(stage_events(make_raw([play("a", "S", BASE, "start")])))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    wide = [x for x in text.splitlines() if "Window" in x and "_beyond" in x]
    assert wide and all("_head" in x for x in wide)
