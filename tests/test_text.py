"""Scalar functions: golden cases, and parity with Unicode-aware regular expressions written independently in Python."""

import re
import unicodedata

import pytest
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmap.functions import arrays as A
from quillmap.functions import text as T


def apply(spark, f, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", f(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows, key=lambda r: r.i)]


GOLDEN = [
    (T.normalize, {"Baker  (night shift)": "baker night shift", "C++ / C#": "c++ c#", "Vue.js!": "vue.js", "Koch â\x80\x93 Köchin": "koch â köchin"}),
    (T.split_list_cell, {"Welding, Soldering ": ["welding", "soldering"], ",, X , ,y z": ["x", "y z"], None: []}),
    (T.clean_title, {
        "Snr. Bridge Painter III [Hybrid]": "bridge painter", "DEPUTY BAKER-FT": "baker", "Assistant Bridge Painter, Trainee": "bridge painter",
        "Associate Baker": "associate baker", "junior staff baker": "baker", "junior staff": "staff", "Well-Bred Horse Groom": "well bred horse groom", "deputy.": "deputy.",
        "Temp Baker 2": "baker", "Permanent Waver": "permanent waver", "Head of Bakery": "head of bakery", "P / T Groom": "p t groom", "Seasonal": "", " \t": "", None: "",
    }),
    (lambda c: F.transform(T.title_candidates(c), lambda x: x["text"]), {"Hybrid | Horse Groom": ["Hybrid | Horse Groom", "horse groom", "Hybrid"], "Planner": [], "Wedding Planner": ["Wedding Planner"], None: []}),
    (lambda c: F.transform(T.title_candidates(c), lambda x: x["key"]), {
        "Jr. Horse Groom III (Seasonal)": ["jr. horse groom iii seasonal", "jr. horse groom iii", "horse groom iii seasonal", "horse groom iii", "horse groom"]}),
    (T.prepare_text, {"pastry cook at the grand hotel": "pastry cook", "pastry cook # 7 00412": "pastry cook", "1888": "1888", None: ""}),
    (T.split_variants, {"baker\n bread maker \n\n": ["baker", "bread maker"], None: []}),
]


@pytest.mark.parametrize("f, cases", GOLDEN)
def test_golden(spark, f, cases):
    assert apply(spark, f, list(cases)) == list(cases.values())


def _words():
    odd = "aZé²٣_ .#+-/|,:()[]{}\t\n\r\x1c\x85\xa0 　ßİΣσ́"
    return st.lists(st.sampled_from([*odd, "senior", "Lead ", " at ", "(x)", " II", "full-time", "associate ", " - ", "ft", " 23", "of "]), max_size=14).map("".join)


def _py_normalize(s):
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s+#.]", " ", s.lower().strip())).strip()


def _py_prefix_loop(s):
    while True:
        less = " ".join(re.sub(T.RANK_PREFIX, " ", s, flags=re.IGNORECASE).split())
        if not less or less == s:
            return s
        s = less


def test_against_python(spark):
    from hypothesis import find, settings  # noqa: F401
    from hypothesis.core import given

    seen = []

    @settings(max_examples=300, database=None, derandomize=True)
    @given(_words())
    def gather(s):
        seen.append(s)

    gather()
    seen[:] = [s for s in seen if not any(unicodedata.category(c) == "Cn" for c in s)]
    assert apply(spark, T.normalize, seen) == [_py_normalize(s) for s in seen]
    assert apply(spark, T.strip, seen) == [s.strip() for s in seen]
    paren, split = re.compile(T.PARENTHESES), re.compile(T.SPLITTERS)
    assert apply(spark, T.drop_parentheses, seen) == [paren.sub(" ", s) for s in seen]
    assert apply(spark, T.title_segments, seen) == [sorted((y for x in split.split(paren.sub(" ", s)) if (y := x.strip())), key=len, reverse=True) for s in seen]
    for pattern, case in ((T.SENIORITY_PREFIX, True), (T.LEVEL_SUFFIX, True), (T.JOB_TYPE_WORD, True), (T.RANK_PREFIX, True), (T.RANK_SUFFIX, True), (T.ROLE_PREFIX_WORD, True), (T.COMPANY_TAIL, True), (T.REQUISITION, False)):
        own = re.compile(pattern, re.IGNORECASE if case else 0)
        assert apply(spark, lambda c, p=T.pinned(pattern, case): F.regexp_replace(c, p, "<>"), seen) == [own.sub("<>", s) for s in seen], pattern
    simple = [_py_normalize(s) for s in seen]
    assert apply(spark, lambda c: T._strip_while(c, T.pinned(T.RANK_PREFIX), 1), simple) == [_py_prefix_loop(s) for s in simple]


def test_lists(spark):
    rows = spark.createDataFrame([(["a", None, "b"],), (None,), ([None, "x"],)], "a array<string>")
    got = rows.select(A.join_list(F.col("a")), A.list_length(F.col("a")), A.n_matched(F.col("a")), A.count_value(F.col("a"), "x")).collect()
    assert [tuple(r) for r in got] == [("a |  | b", 3, 2, 0), ("", 0, 0, 0), (" | x", 2, 1, 1)]
