import datetime

import pytest

from tallymark.plans import run_log

KEY = "state_code string, report string, from_year int, to_year int"
T = [datetime.datetime(2026, 1, 1, 0, i) for i in range(9)]


def event(minute, code, status, message=None, report="fuel", year=2020):
    return (T[minute], code, report, year, year, status, message)


@pytest.fixture
def events(spark, tmp_path):
    """Appended in parts and out of order, with quotes, breaks and damage in it."""
    path = str(tmp_path / "log")
    parts = [
        [event(3, "aa", "SUCCESS"), event(1, "aa", "FAILED", 'time "out", again')],
        [event(2, "bb", "FAILED", "x"), event(1, "bb", "SUCCESS"), event(5, "cc", "SKIPPED")],
        [event(4, "cc", "FAILED"), event(6, "dd", "lost?"), event(2, "zz", "SUCCESS", report="age")],
        [event(7, "ee", "FAILED", "a"), event(7, "ee", "SUCCESS", "b"), (None, "ff", "fuel", 2020, 2020, "FAILED", None)],
    ]
    for part in parts:
        run_log.append_events(spark.createDataFrame(part, run_log.EVENT_SCHEMA), path)
    return run_log.read_events(spark, path)


@pytest.fixture
def coverage(spark):
    found = {"aa": "DELIVERED", "bb": "MISSING", "cc": "MISSING", "dd": "MISSING", "ee": "MISMATCH",
             "ff": "DELIVERED", "gg": "DELIVERED"}
    return spark.createDataFrame(
        [(c, "fuel", 2020, 2020, s) for c, s in found.items()], f"{KEY}, status string")


def test_last_status_attempts_and_verdict(events, coverage):
    got = {r.state_code: (r.attempts, r.failures, r.last_status, r.first_success, r.verdict)
           for r in run_log.run_status(coverage, events).collect()}
    assert got == {
        "aa": (2, 1, "SUCCESS", T[3], "DONE"),
        "bb": (2, 1, "FAILED", T[1], "RETRY"),
        "cc": (1, 1, "SKIPPED", None, "LOST"),
        "dd": (0, 0, "NOT RUN", None, "OPEN"),
        "ee": (2, 1, "SUCCESS", T[7], "WRONG MONTHS"),
        "ff": (1, 1, "FAILED", None, "NOT LOGGED"),
        "gg": (0, 0, "NOT RUN", None, "NOT LOGGED"),
    }
    status = run_log.run_status(coverage, events)
    assert {r.state_code for r in run_log.to_fetch(status).collect()} == {"bb", "cc", "dd", "ee"}


def test_messages_and_strangers(events, coverage):
    messages = {r.state_code: r.last_message for r in run_log.standing(events).collect()}
    assert messages["bb"] == "x" and messages["aa"] == ""
    assert 'time "out", again' in [r.message for r in events.collect()]
    [stranger] = run_log.strangers(coverage, events).collect()
    assert (stranger.state_code, stranger.report) == ("zz", "age")


def test_no_events(spark, coverage):
    empty = spark.createDataFrame([], run_log.EVENT_SCHEMA)
    got = run_log.run_status(coverage, empty)
    assert {r.verdict for r in got.collect()} == {"OPEN", "WRONG MONTHS", "NOT LOGGED"}
