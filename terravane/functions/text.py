"""Names, labels and rules on text. Patterns are case-insensitive searches."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing about which market a name means, longest alternatives first where they overlap.
GENERIC_WORDS = ["ตลาดนัด", "ตลาดสด", "ตลาด", "market", "night", "walking street", "ถนนคนเดิน", "food", "the", "นัด"]

# Kind of a market by the first pattern that its name has.
KINDS = [
    ("โต้รุ่ง", "ตลาดโต้รุ่ง"),
    ("walking street|ถนนคนเดิน", "ถนนคนเดิน"),
    ("night market|ไนท์|ตลาดกลางคืน", "ตลาดกลางคืน"),
    ("ตลาดนัด", "ตลาดนัด"),
    ("ตลาดเช้า", "ตลาดเช้า"),
    ("ตลาดเย็น", "ตลาดเย็น"),
]
OTHER_KIND = "ตลาดทั่วไป"

# Districts and the spellings that addresses have.
DISTRICTS = [
    ("เมืองชลบุรี", ["เมืองชลบุรี", "อ.เมือง", "อำเภอเมือง", "mueang chon buri", "mueang chonburi"]),
    ("บ้านบึง", ["บ้านบึง", "ban bueng"]),
    ("หนองใหญ่", ["หนองใหญ่", "nong yai"]),
    ("บางละมุง", ["บางละมุง", "bang lamung", "พัทยา", "pattaya"]),
    ("พานทอง", ["พานทอง", "phan thong"]),
    ("พนัสนิคม", ["พนัสนิคม", "phanat nikhom"]),
    ("ศรีราชา", ["ศรีราชา", "si racha", "sri racha", "sriracha"]),
    ("เกาะสีชัง", ["เกาะสีชัง", "ko si chang", "koh sichang"]),
    ("สัตหีบ", ["สัตหีบ", "sattahip"]),
    ("บ่อทอง", ["บ่อทอง", "bo thong"]),
    ("เกาะจันทร์", ["เกาะจันทร์", "ko chan", "koh chan"]),
]
NO_DISTRICT = "ไม่ระบุ"

# Letters of the days, Sunday first.
DAY_LETTERS = ["อา", "จ", "อ", "พ", "พฤ", "ศ", "ส"]


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def found(c: Column, pattern: str) -> Column:
    """Does the pattern occur; never for a null, nor for an empty pattern."""
    return F.lit(False) if not pattern else F.coalesce(c.rlike(f"(?iu){pattern}"), F.lit(False))


def first_rule(rules: list[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def slug(c: Column) -> Column:
    """Part of a column name: runs of other characters than digits, Latin and Thai become _, none at the ends; lower case;
    other for what is empty or null."""
    text = F.lower(F.btrim(F.regexp_replace(c, "[^0-9a-zA-Zก-๙]+", "_"), F.lit("_")))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("other"))


def normal_name(c: Column) -> Column:
    """A name without generic words, marks and spaces."""
    text = F.regexp_replace(F.lower(blank(c)), "|".join(GENERIC_WORDS), " ")
    return F.regexp_replace(text, "[^0-9a-zก-๙]+", "")


def _ratio_reached(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() >= 0.6 for x, y in zip(a, b, strict=True)], dtype=bool)


def shared_letters(a: Column, b: Column) -> Column:
    """Letters that two texts have in common, each as often as both have it: what a matching of runs can reach at most."""
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    return F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.least(times(a, c), times(b, c)))


def one_holds_the_other(a: Column, b: Column) -> Column:
    return (F.length(a) >= 3) & (F.length(b) >= 3) & (a.contains(b) | b.contains(a))


def may_be_similar(a: Column, b: Column) -> Column:
    """Whether the matching ratio of two normal names can reach 0.6, by the letters that they share."""
    return (a != "") & (b != "") & (2.0 * shared_letters(a, b) / (F.length(a) + F.length(b)) >= 0.6)


def ratio_reached(a: Column, b: Column) -> Column:
    """Is the matching ratio 0.6 or more; it depends on the order of its arguments. In Python, by Arrow batches: ask only
    where may_be_similar holds."""
    return F.pandas_udf(_ratio_reached, "boolean")(a, b)


def similar_names(a: Column, b: Column) -> Column:
    """Do normal names mean the same: one holds the other (3 characters or more), or their matching ratio is 0.6."""
    return (a != "") & (b != "") & (one_holds_the_other(a, b) | (may_be_similar(a, b) & ratio_reached(a, b)))


def market_kind(name: Column) -> Column:
    return first_rule([(found(name, p), k) for p, k in KINDS], OTHER_KIND)


def district(address: Column) -> Column:
    """District by the first alias in table order, else by the words for one, else NO_DISTRICT."""
    low = F.lower(blank(address))
    thai, english = F.regexp_extract(blank(address), r"(?:อำเภอ|อ\.)\s*([^\s,]+)", 1), F.regexp_extract(blank(address), "([A-Za-z][A-Za-z ]+?) District", 1)
    rules = [(F.exists(F.array(*map(F.lit, aliases)), lambda a: low.contains(a)), name) for name, aliases in DISTRICTS]
    return first_rule([*rules, (thai != "", thai), (english != "", F.trim(english))], NO_DISTRICT)


def day_letters(mask: Column) -> Column:
    letters = F.array(*map(F.lit, DAY_LETTERS))
    return F.array_join(F.filter(F.transform(letters, lambda d, i: F.when(F.substring(blank(mask), i + 1, F.lit(1)) == "1", d)), lambda d: d.isNotNull()), " ")


def label_name(tags: Column) -> Column:
    """The first of name, name:th and name:en in a map of tags that is not empty."""
    return F.coalesce(*(F.nullif(F.try_element_at(tags, F.lit(k)), F.lit("")) for k in ("name", "name:th", "name:en")), F.lit(""))


def score_band(score: Column) -> Column:
    """Colour of a score on a map."""
    return first_rule([(score >= 75, "#1a9850"), (score >= 55, "#91cf60"), (score >= 40, "#fee08b")], "#d73027")


def half_even(c: Column, places: int) -> Column:
    """Rounded the way numpy rounds a column: scaled, to the even neighbour on ties, scaled back."""
    return F.rint(c * float(10**places)) / float(10**places)
