import duckdb
import pytest
from pyspark.sql import functions as F

from terravane.llm import mixing
from terravane.llm.queries import MIX_SHARE, MIX_WEIGHTS, SQL

ROWS = (
    [(i, "word " * (i % 37 + 1), ("en", "de", "fr", None)[i % 4], f"src{i % 7}", 1) for i in range(600)]
    + [(1000 + i, "x y z " * 200, "en", "src3", 1) for i in range(150)]  # a hot source
    + [(2000, None, "en", "src1", 1), (2001, "", "en", "src9", 1), (None, "a b", "en", "src1", 1), (2002, "a b", None, None, 1), (2003, "a b", "en", "odd", 1)]
    + [(5, "word word", "de", "src5", 1)] * 3
)
DOCS = "doc_id long, text string, lang string, source string, epoch int"


def fill(budget, caps, weights):
    """Budgets of siblings: shares by weight; what one cannot use goes to the others."""
    left, open_, got = min(budget, sum(caps.values())), {k for k in caps if weights[k] > 0}, dict.fromkeys(caps, 0)
    while open_:
        share = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        full = {k for k in open_ if caps[k] <= share[k]}
        if not full:
            return got | {k: int(share[k]) for k in open_}
        for k in full:
            got[k] = caps[k]
            left -= caps[k]
        open_ -= full
    return got


def test_allocation_by_hand(spark):
    leaves = {("a", "x", "1"): 100, ("a", "x", "2"): 10, ("a", "y", "3"): 1000, ("b", "x", "4"): 5, ("b", "z", "5"): 20, ("c", "x", "6"): 400}
    weights = {"domain": {"a": 1.0, "b": 6.0, "c": 1.0}, "lang": {"y": 3.0, "z": 0.0}}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, capacity long")
    got = {tuple(r[:3]): r.budget for r in mixing.allocate(df, ["domain", "lang", "source"], weights, F.lit(700)).collect()}
    # b can use 5 only (z has no weight): 695 for a and c, 347.5 each; then x : y = 1 : 3 inside a
    assert got == {("b", "x", "4"): 5, ("b", "z", "5"): 0, ("c", "x", "6"): 347, ("a", "y", "3"): 260, ("a", "x", "1"): 76, ("a", "x", "2"): 10}


@pytest.mark.parametrize("share", [0.1, MIX_SHARE, 3.0, 9.0])
def test_budgets_and_prefixes(spark, share):
    docs = spark.createDataFrame(ROWS, DOCS)
    got = mixing.mix_sources(docs, MIX_WEIGHTS, share, max_epochs=4).collect()
    tokens, leaf = {}, {}
    for i, t, lang, source, _ in ROWS:
        n = len((t or "").split())
        number = "".join(c for c in source or "" if c.isdigit())
        k = (f"d{int(number) % 4}" if number else "none", lang or "", source or "")
        leaf.setdefault(k, []).append((i, n))
        tokens[k] = tokens.get(k, 0) + n
    tree = {}
    for (d, l, s), n in tokens.items():
        tree.setdefault(d, {}).setdefault(l, {})[s] = 4 * n
    weight = lambda level, keys: {k: MIX_WEIGHTS.get(level, {}).get(k, 1) for k in keys}
    budget = {}
    for d, b in fill(int(sum(tokens.values()) * share), {d: sum(sum(x.values()) for x in t.values()) for d, t in tree.items()}, weight("domain", tree)).items():
        for l, c in fill(b, {l: sum(x.values()) for l, x in tree[d].items()}, weight("lang", tree[d])).items():
            budget |= {(d, l, s): e for s, e in fill(c, tree[d][l], weight("source", tree[d][l])).items()}
    spent, epochs = {}, {}
    for r in got:
        k = (r.domain, r.lang, r.source)
        spent[k] = spent.get(k, 0) + r.n_tokens
        epochs.setdefault((k, r.epoch), []).append((r.doc_id, r.n_tokens))
    for k, n in tokens.items():
        most = max(x for _, x in leaf[k])
        assert spent.get(k, 0) <= budget[k] and (budget[k] - spent.get(k, 0) < most or spent.get(k, 0) == 4 * n or n == 0), k
        whole = budget[k] // n if n else 0
        order = lambda rows: sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        assert all(order(epochs[k, e]) == order(leaf[k]) for e in range(whole))
    assert all(len(v) <= len(leaf[k]) for (k, _), v in epochs.items())


def test_equals_sql(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(map(repr, c.sql(SQL["op9_mix_sources"]).fetchall()))
    got = sorted(repr(tuple(r)) for r in mixing.mix_sources(docs, MIX_WEIGHTS, MIX_SHARE).collect())
    assert got == want and len(got) > 100


def test_no_rows_and_no_python(spark):
    docs = spark.createDataFrame([], DOCS)
    out = mixing.mix_sources(docs, MIX_WEIGHTS)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
