"""Text functions as native expressions, with Unicode classes pinned: nothing here depends on the JDK's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the cleaning rules, as Unicode-aware regular expressions write them, and the roles too
# generic to name an occupation. The splitters and the requisition code are case-sensitive, the others are not.
PARENTHESES = r"[\(\[\{].*?[\)\]\}]"
SPLITTERS = r"\s+-\s+|\s+\|\s+|\s+/\s+|\s+at\s+|\s*,\s*|\s+:\s+"
SENIORITY_PREFIX = r"^(sr|snr|senior|jr|junior|lead|principal|staff|entry[ -]?level|assistant|associate|head of|deputy)\b[.\s]*"
LEVEL_SUFFIX = r"\s+(i{1,3}|iv|v|\d)$"
JOB_TYPE_WORD = r"\b(ft|pt|f\s*/\s*t|p\s*/\s*t|full[\s-]?time|part[\s-]?time|fulltime|parttime|prn|per\s+diem|temp|temporary|seasonal|remote|onsite|on[\s-]site|hybrid|w2|1099|hourly|salaried)\b"
RANK_PREFIX = r"^\s*(sr|snr|senior|jr|junior|lead|principal|staff|entry[\s-]?level|experienced|trainee|graduate|new\s+grad|mid[\s-]?level|deputy)\b[.\s]*"
RANK_SUFFIX = r"[\s,-]+(sr|snr|senior|jr|junior|lead|principal|staff|entry[\s-]?level|experienced|trainee|graduate|new\s+grad|mid[\s-]?level|deputy)\s*$"
ROLE_PREFIX_WORD = r"^\s*(associate|assistant)\b[.\s]*"
COMPANY_TAIL = r"\s+at\s+.*$"
REQUISITION = r"[\s\-#]*\b\d[\w\d]*\s*$"
GENERIC_ROLES = [
    "supervisor", "assistant", "technician", "director", "manager", "associate", "coordinator", "specialist", "consultant",
    "analyst", "lead", "engineer", "intern", "staff", "officer", "agent", "clerk", "operator", "worker", "professional",
    "executive", "representative", "administrator", "advisor", "adviser", "trainee", "apprentice", "expert", "generalist",
    "partner", "head", "chief", "president", "owner", "member", "employee", "contractor", "volunteer", "remote", "part time",
    "full time", "other", "driver", "teacher", "designer", "editor", "inspector", "installer", "planner", "general",
    "controller", "host",
]

# What \w, \s and \d stand for: word characters, white space and digits of all scripts.
WORD = r"\p{L}\p{N}_"
SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DIGIT = r"\p{Nd}"
_S = f"[{SPACE}]"
_EDGE = f"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"


def pinned(pattern: str, ignore_case: bool = True) -> str:
    """The pattern in the JVM's notation, with the classes above whatever the JVM's own are; `$` also stands before a last line break."""
    inside = {"s": SPACE, "w": WORD, "d": DIGIT}
    outside = {k: f"[{v}]" for k, v in inside.items()} | {"b": _EDGE}
    plain = {"^": r"\A", "$": r"(?=\n?\z)", ".": r"[^\n]"}
    out, bracket, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out.append((inside if bracket else outside).get(pattern[i], c + pattern[i]))
        else:
            out.append(c if bracket else plain.get(c, c))
            bracket = c == "[" or bracket and c != "]"
        i += 1
    return ("(?iu)" if ignore_case else "") + "".join(out)


def strip(c: Column) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(c, rf"\A{_S}+|{_S}+\z", "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{_S}+", " "))


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def normalize(c: Column) -> Column:
    """The key of a label: lower case, only word characters and + # . kept, single spaces."""
    return squeeze(F.regexp_replace(strip(F.lower(c)), f"[^{WORD}{SPACE}+#.]", " "))


def drop_parentheses(c: Column) -> Column:
    return F.regexp_replace(c, pinned(PARENTHESES), " ")


def _strip_while(c: Column, pattern: str, min_words: int) -> Column:
    """Replace the pattern again and again, as long as something else of min_words words or more is left."""

    def once(text: Column, _: Column) -> Column:
        def keep(less: Column) -> Column:
            stop = (less == "") | (less == text) | (F.size(F.split(less, " ")) < min_words)
            return F.when(stop, text).otherwise(less)

        return _stage(squeeze(F.regexp_replace(text, pattern, " ")), keep)

    # Every step that changes anything shortens the text, so its word count bounds the steps.
    return F.aggregate(F.sequence(F.lit(0), F.size(F.split(c, " "))), c, once)


def _stage(c: Column, *steps) -> Column:
    """Apply steps one after another, each value computed once (expressions are trees; a lambda's argument is shared)."""
    held = F.array(c)
    for step in steps:
        held = F.transform(held, step)
    return F.element_at(held, 1)


def clean_title(c: Column) -> Column:
    """A raw title reduced to the occupation it names; empty if nothing is left, for null and blank ones too."""
    level = lambda x: strip(F.regexp_replace(x, pinned(LEVEL_SUFFIX), ""))
    cleaned = _stage(
        c,
        lambda x: F.regexp_replace(drop_parentheses(F.lower(x)), r"[-/_|]+", " "),
        lambda x: F.regexp_replace(F.regexp_replace(x, pinned(JOB_TYPE_WORD), " "), f"[^{WORD}{SPACE}+#.]", " "),
        lambda x: level(squeeze(x)),
        lambda x: _strip_while(x, pinned(RANK_PREFIX), 1),
        lambda x: _strip_while(x, pinned(RANK_SUFFIX), 1),
        lambda x: _strip_while(x, pinned(ROLE_PREFIX_WORD), 2),
        lambda x: squeeze(level(x)),
    )
    return F.when(blank(c), "").otherwise(cleaned)


def peel(c: Column) -> Column:
    """One rank off the front, then a level off the end."""
    return strip(F.regexp_replace(F.regexp_replace(c, pinned(SENIORITY_PREFIX), ""), pinned(LEVEL_SUFFIX), ""))


def title_segments(c: Column) -> Column:
    """The pieces between splitters, longest first, equals in order."""
    parts = F.filter(F.transform(F.split(drop_parentheses(c), pinned(SPLITTERS, False)), strip), lambda x: x != "")
    keyed = F.transform(parts, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def title_candidates(c: Column) -> Column:
    """Ever shorter forms of a title, the most trustworthy first: one of each key, none empty or generic."""
    bare = drop_parentheses(c)
    whole = F.when(bare == c, F.array(c)).otherwise(F.array(c, bare))
    segments = F.flatten(F.transform(title_segments(c), lambda s: F.array(s, peel(s))))
    forms = F.concat(whole, F.transform(whole, peel), F.array(clean_title(c)), segments)
    kept = _stage(
        F.transform(forms, lambda x: F.struct(x.alias("text"), normalize(x).alias("key"))),
        lambda z: F.filter(z, lambda x: (x["key"] != "") & ~x["key"].isin(GENERIC_ROLES)),
        lambda z: F.filter(z, lambda x, i: F.array_position(z["key"], x["key"]) == i + 1),
    )
    return F.when(blank(c), F.array().cast("array<struct<text:string,key:string>>")).otherwise(kept)


def prepare_text(c: Column, use_clean_title: bool = True) -> Column:
    """What is encoded of a title: without employer and requisition codes, cleaned, or raw where nothing is left."""
    code = lambda x: strip(F.regexp_replace(x, pinned(REQUISITION, False), ""))
    text = _stage(c, lambda x: strip(F.regexp_replace(x, pinned(COMPANY_TAIL), "")), code, code)
    text = F.when(text == "", c).otherwise(text)
    if use_clean_title:
        text = _stage(text, lambda x: F.struct(x.alias("raw"), clean_title(x).alias("clean")), lambda s: F.when(s["clean"] != "", s["clean"]).otherwise(strip(s["raw"])))
    else:
        text = strip(text)
    return F.when(c.isNull(), "").otherwise(text)


def split_list_cell(c: Column) -> Column:
    """Comma-packed terms: stripped, lower-cased, blanks dropped; null gives an empty list."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.lower(strip(x))), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def split_variants(c: Column) -> Column:
    """Newline-packed labels: stripped, blanks dropped; null gives an empty list."""
    return F.coalesce(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), F.array().cast("array<string>"))


def embed_text(label: Column, description: Column, chars: int = 200) -> Column:
    """`label - description`, the latter cut, or the label alone."""
    return F.when(F.coalesce(description, F.lit("")) != "", F.concat(label, F.lit(" - "), F.substring(description, 1, chars))).otherwise(label)


def same_label(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)
