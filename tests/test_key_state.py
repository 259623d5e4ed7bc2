import random

from tallymark.operators import checks, keys
from tallymark.plans import quality
from tallymark.schemas import BUSINESS_KEY, SILVER_COLUMNS, SILVER_SCHEMA


def soiled(spark, market):
    """Equal copies, conflicting ones, fully equal rows, NULL keys, sources and counts."""
    draw = random.Random(3)
    rows = [tuple(r) for r in market([
        ("Fuel", draw.choice(["an", "ap"]), f"V{draw.randrange(12)}", f"2020-{draw.randrange(1, 4):02d}",
         draw.randrange(3), f"s{draw.randrange(4)}.csv") for _ in range(300)]).collect()]
    at = {c: i for i, c in enumerate(SILVER_COLUMNS)}
    for i, column in enumerate(["source_file", "vehicle_count", "state_code", "dimension_value", "date"]):
        for row in rows[i * 20:i * 20 + 10]:
            changed = list(row)
            changed[at[column]] = None
            rows.append(tuple(changed))
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def test_state_tells_what_the_rows_tell(spark, market, rows):
    df = soiled(spark, market).dropDuplicates()
    state = keys.key_state(df)
    assert rows(keys.state_counts(state)) == rows(keys.keyed_counts(df))
    assert rows(keys.summary_of(keys.state_counts(state))) == rows(keys.dedup_summary(df))
    key_and_order = [*BUSINESS_KEY, "source_file", "vehicle_count"]
    assert rows(keys.first_rows(state, SILVER_COLUMNS), *key_and_order) == rows(
        keys.first_per_key(df), *key_and_order)
    assert keys.first_rows(state, SILVER_COLUMNS).schema.names == SILVER_COLUMNS


def test_checks_from_a_state(spark, market, rows):
    df = soiled(spark, market)
    for frame in (df, df.dropDuplicates(BUSINESS_KEY), df.limit(0)):
        state = keys.key_state(frame)
        assert rows(checks.duplicate_counts(frame, state=state)) == rows(checks.duplicate_counts(frame))
        assert rows(quality.dq_silver(frame, state=state)) == rows(quality.dq_silver(frame))


def test_states_merge(spark, market, rows):
    df = soiled(spark, market)
    parts = [keys.key_state(df.filter(f"pmod(hash(dimension_value, source_file), 3) = {i}"))
             for i in range(3)]
    assert rows(keys.merge_states(*parts)) == rows(keys.key_state(df))


def test_state_is_one_exchange(spark, market):
    plan = keys.key_state(market([("Fuel", "an", "V", "2020-01", 1)]))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1
