import hashlib
import random

from terravane.llm import secret_scan as S

DOCS = "doc_id long, text string, lang string, secret_spans string"


def brute(text):
    found = []
    for kind, pattern, group, fewest in S.RULES:
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if len(m[group]) >= fewest]
    return sorted(found, key=lambda s: (s[1], S.KINDS.index(s[0])))


def test_rules_match_plain_search():
    rng = random.Random(4)
    pieces = ["password", "Token", "api_key", "apikey", "SECRET", " : ", "=", "'", '"', "AKIA", "ABCDEFGHIJKLMNOPQRST", "0123456789abcdef", "abcdef0123", " ", "é", "\n", "short", "ſecret", "x-y_z"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(30)))
        assert S.spans_of(text, None) == brute(text)


def test_model_tells_random_strings_from_identifiers():
    model = S.train(S.samples())
    held = S.samples(600, seed=99)
    good = sum((S.ratio(t, model) > 0) == is_random for t, is_random in held if len(t) >= 20)
    assert good / sum(len(t) >= 20 for t, _ in held) > 0.97
    key = "ghp_16C7e42F292c6912E7710c838347Ae178B4a"
    assert S.spans_of(f"see {key} there", model) == [("markov", 4, 4 + len(key))]
    assert S.spans_of("my_very_long_identifier_name_for_version_2 and some-long-article-title-2024", model) == []


def test_scan_keeps_rows_and_handles_odd_input(spark):
    secret = "token = \"0123456789abcdef0123456789abcdef01234567\""
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, secret, None, "x"), (3, secret, None, "x"), (None, "é" + secret, "fr", "x"), (5, "word " * 40000 + secret, "en", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = S.digest_columns(S.scan_secrets(docs)).collect()
    assert len(got) == 6
    none = hashlib.sha256(b"").hexdigest()
    for r in got:
        spans = brute(next(x[1] for x in rows if x[0] == r.doc_id) or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == (hashlib.sha256(line.encode()).hexdigest() if line else none)
        assert r.spans == line and r.n_assign == sum(k == "assign" for k, _, _ in spans) and r.n_hex == len(spans) - r.n_assign
    assert S.scan_secrets(docs.limit(0)).count() == 0
    clean = S.scan_secrets(docs, mask="[secret]").filter("doc_id = 3").collect()
    assert {r.text for r in clean} == {"[secret]\""}


def test_model_sees_every_string_it_is_trained_for():
    model = S.train(S.samples())
    rng = random.Random(11)
    draw = lambda n, chars=S.ALPHABET[:62]: "".join(rng.choice(chars) for _ in range(n))
    key, letters, short = draw(32), draw(32, S.ALPHABET[:52]), draw(17)
    cuts = lambda text: [text[a:b] for k, a, b in S.spans_of(text, model) if k == "markov"]
    assert cuts(f"see {letters} there") == [letters] and cuts(f"see {short} there") == [short]
    path = "services/connections/subscriptions/permissions/collections/"
    assert cuts(f"{path}{key}/configuration/information/multiprocessing") == [key]
    other = draw(28)
    far = "_configuration_information_multiprocessing_subscriptions_"
    assert cuts(f"{path}{key}{far}{other}{far}settings") == [key, other]
    beside = cuts(f"AKIA{draw(20, S.ALPHABET[:26])}/{key}")
    assert [x.strip("/") for x in beside] == [key]
    held = [t for t, is_random in S.samples(1500, seed=99) if is_random]
    assert sum(any(k in ("markov", "hex") for k, _, _ in S.spans_of(t, model)) for t in held) >= 0.99 * len(held)
    plain = [t for t, is_random in S.samples(1500, seed=99) if not is_random]
    assert not any(S.spans_of(t, model) for t in plain)
