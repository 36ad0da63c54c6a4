import hashlib
import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from terravane.operators import answers

SCHEMA = "sku string, key string, request string, value string, at timestamp, seq long"


def key_of(**fields):
    return hashlib.sha1(json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def test_resume_asks_for_the_rest(spark, tmp_path):
    df = spark.createDataFrame([(i % 40, f"café {i % 7}" if i % 5 else None) for i in range(200)], "id int, name string")
    wanted = answers.requests_of(df, "search", ["name", "id"])
    different = {(i % 40, f"café {i % 7}" if i % 5 else None) for i in range(200)}
    assert sorted(r.key for r in wanted.collect()) == sorted(key_of(id=i, name=n) for i, n in different)
    path, when, left = str(tmp_path / "log"), datetime(2024, 5, 1), len(different)
    for run in range(3):  # a run that stops after some answers; the next goes on from there
        log = answers.read_answers(spark, path) if run else spark.createDataFrame([], SCHEMA)
        todo = answers.pending_requests(wanted, log)
        assert todo.count() == left
        some = todo.orderBy("key").limit(40)
        got = [(r.sku, r.key, r.request, "{}", when + timedelta(days=run), 0) for r in some.collect()]
        answers.append_answers(spark, path, spark.createDataFrame(got, SCHEMA))
        left = max(0, left - 40)
    first = answers.fetched_range(answers.read_answers(spark, path)).first()
    assert tuple(first) == ("2024-05-01", "2024-05-03")
    assert answers.fetched_range(spark.createDataFrame([], SCHEMA)).first().first is None


def test_the_last_write_counts(spark):
    rng, start = random.Random(3), datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        hot = rng.random() < 0.4
        at = None if rng.random() < 0.05 else start + timedelta(hours=rng.randrange(30))
        rows.append(("s", "hot" if hot else f"k{rng.randrange(50)}", "{}", rng.choice(["a", "b", None]), at, rng.choice([0, 1, None])))
    rows += rows[:100]  # repeats
    last, writes = {}, {}
    rank = lambda r: tuple((x is not None, x) for x in (r[4], r[5], r[3]))
    for r in rows:
        writes[r[1]] = writes.get(r[1], 0) + 1
        if r[1] not in last or rank(r) > rank(last[r[1]]):
            last[r[1]] = r
    log = spark.createDataFrame(rng.sample(rows, len(rows)), SCHEMA).repartition(6)
    got = {r.key: (r.value, r.at, r.writes) for r in answers.answer_log(log).collect()}
    assert got == {k: (r[3], r[4], writes[k]) for k, r in last.items()}
    wanted = spark.createDataFrame([("s", k, "{}") for k in [*last, "new"]] + [("other", "hot", "{}")], "sku string, key string, request string")
    want = {("s", k) for k, r in last.items() if r[3] is None} | {("s", "new"), ("other", "hot")}
    assert {(r.sku, r.key) for r in answers.pending_requests(wanted, log).collect()} == want
    short = answers.compacted(log)
    assert short.count() == len(last) and answers.answer_log(short).select("key", "value").exceptAll(answers.answer_log(log).select("key", "value")).isEmpty()
    assert answers.answer_log(log.filter(F.lit(False))).count() == 0
