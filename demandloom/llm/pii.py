"""Personal data by expressions, checksums and context words, in DataFrame functions only.

Base kinds are email, ip, card and phone; the method adds bank account numbers (iban, confirmed
mod 97), identity numbers (ssn) and access secrets (secret, long runs of letters and digits). Every
span has a score: a prior of its kind, raised by a passed checksum and by context words
shortly before it. Base spans always stay; added kinds need ``MIN_SCORE``, which those without
a checksum reach only in context.

Offsets come from marking matches in the text: matches stand between two private-use
characters, the text is split there, and running lengths, summed in blocks, give code points. Classes are
possessive and start only where a run starts, so that long runs and many matches cost linear time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.common import once, table

MARK, STAND_IN = "\ue000", "\ue001"
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")

_LOCAL = "A-Za-z0-9._%+-"
#: A start within a run is possible only right after a match, which \G stands for.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])",
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
    "secret": r"[A-Za-z0-9+/_-]{20,}+",
}
#: Cheap tests that a text must pass before the pattern runs at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -]", "phone": r"\+[0-9]", "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]-[0-9]{2}-[0-9]"}
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.4, "ssn": 0.4, "secret": 0.3}
CHECKED = {"card": 0.4, "iban": 0.5}
CONTEXT_BONUS, CONTEXT_CHARS, MIN_SCORE = 0.2, 48, 0.5
CONTEXT = {
    "email": "e-?mail|contact|mail to|write",
    "ip": r"\bip\b|address|host|server|login",
    "card": "card|visa|master|credit|debit|payment",
    "phone": "phone|call|tel|mobile|fax|dial",
    "iban": "iban|account|bank|transfer",
    "ssn": "ssn|social|security|tax id|identity",
    "secret": "token|secret|passw|credential|api.?key|access.?key|private.?key|auth",
}
#: Entries of a block of running lengths; the last of LEVELS levels has an entry for BLOCK ** LEVELS parts.
BLOCK, LEVELS = 64, 2
NEEDS["secret"] = f"(?i){CONTEXT['secret']}"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True for a digit string whose Luhn sum is a multiple of 10."""
    at = F.reverse(F.split(digits, ""))
    values = F.transform(at, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") / 5).cast("int")))
    return F.pmod(F.aggregate(values, F.lit(0), lambda a, x: a + x), F.lit(10)) == 0


def mod97(account: Column) -> Column:
    """True if the account number, its first four characters moved to the end and letters as 10 to 35, is 1 modulo 97."""
    tight = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substr(tight, F.lit(5)), F.substring(tight, 1, 4)), "")
    rest = F.aggregate(
        moved, F.lit(0), lambda a, c: F.when(c.between("0", "9"), F.pmod(a * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97)))
    )
    return rest == 1


def _octet(part: Column) -> Column:
    tight = F.ltrim(part, F.lit("0"))
    return (F.char_length(tight) < 3) | ((F.char_length(tight) == 3) & (tight <= "255"))


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _octet)
    if kind == "card":
        digits = _digits(match)
        return F.char_length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.char_length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "ssn":  # areas, groups and serials that are never issued
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def before(sizes: Column, levels: int = LEVELS) -> Column:
    """For each entry of a bound array the sum of the entries before it.

    Blocks of BLOCK entries are summed first and the sums before each block come from the same function, so an
    entry adds up at most BLOCK numbers a level however long the array is.
    """
    inner = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    if not levels:
        return F.transform(sizes, lambda x, k: inner(F.slice(sizes, 1, k)))
    block = lambda k: F.floor(k / BLOCK).cast("int")
    sums = F.transform(F.sequence(F.lit(0), block(F.greatest(F.size(sizes), F.lit(1)) - 1)), lambda b: inner(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
    return once(
        once(sums, lambda s: before(s, levels - 1)),
        lambda earlier: F.transform(sizes, lambda x, k: F.get(earlier, block(k)) + inner(F.slice(sizes, block(k) * BLOCK + 1, k % BLOCK))),
    )


def spans(kind: str, text: Column) -> Column:
    """array<struct<start, kind_no, kind, end, score>> of a non-null text that holds no MARK."""
    parts = F.split(F.regexp_replace(text, f"({PATTERNS[kind]})", f"{MARK}$1{MARK}"), MARK, -1)  # parts 1, 3, ... are matches

    def match(all_parts: Column, starts: Column, k: Column) -> Column:
        return F.struct(F.get(starts, k).alias("at"), F.get(all_parts, k).alias("text"), F.right(F.get(all_parts, k - 1), F.lit(CONTEXT_CHARS)).alias("before"))

    def scored(x: Column) -> Column:
        score = F.lit(PRIOR[kind] + CHECKED.get(kind, 0.0)) + F.when(F.lower(x["before"]).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(x["at"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), (x["at"] + F.char_length(x["text"])).alias("end"), F.least(score, F.lit(1.0)).alias("score"))

    def found(all_parts: Column) -> Column:
        matches = once(once(F.transform(all_parts, lambda p: F.char_length(p)), lambda sizes: before(sizes)), lambda starts: F.transform(F.sequence(F.lit(1), F.size(all_parts) - 2, F.lit(2)), lambda k: match(all_parts, starts, k)))
        spans_ = F.transform(F.filter(matches, lambda x: valid(kind, x["text"])), scored)
        return spans_ if kind in BASE else F.filter(spans_, lambda x: x["score"] >= MIN_SCORE)

    none = F.array().cast("array<struct<start:int,kind_no:int,kind:string,end:int,score:double>>")
    return F.when(text.rlike(NEEDS[kind]), once(parts, lambda all_parts: F.when(F.size(all_parts) > 1, found(all_parts)).otherwise(none))).otherwise(none)


def find_personal_data(docs: DataFrame, text_col: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with ``name``: array<struct<start, kind_no, kind, end, score>>, by start, then kind.

    start and end are code points, end exclusive. A null or empty text has no spans; a very
    long one is searched whole; spans of different kinds may overlap; repeated rows get equal spans;
    an empty table gives an empty one. A column called ``name`` is replaced, all others stay.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), MARK, STAND_IN)
    every = F.array_sort(F.concat(*(spans(k, text) for k in KINDS)))
    return docs.withColumn(name, F.when(F.col(text_col).rlike("[0-9@]"), every).otherwise(F.array().cast("array<struct<start:int,kind_no:int,kind:string,end:int,score:double>>")))


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("pii", lambda s: s["kind_no"] < len(BASE))
    scores = F.array_join(F.transform("pii", lambda s: F.round(100 * s["score"]).cast("int").cast("string")), ",")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"), scores.alias("score_pct")
    )


def _duck(kind: str, pattern: str, ok: str) -> str:
    score = f"least({PRIOR[kind] + CHECKED.get(kind, 0.0)} + CASE WHEN regexp_matches(lower(before), '{CONTEXT[kind]}') THEN {CONTEXT_BONUS} ELSE 0 END, 1.0)"
    enough = "" if kind in BASE else f" AND {score} >= {MIN_SCORE}"
    return f"""
{kind}_parts AS (
  SELECT doc_id, string_split(regexp_replace(t, '({pattern})', chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)) AS p FROM base),
{kind}_at AS (
  SELECT doc_id, p[i] AS m, right(p[i - 1], {CONTEXT_CHARS}) AS before, i, length(array_to_string(p[1:i - 1], '')) AS s FROM (SELECT doc_id, p, unnest(range(2, len(p), 2)) AS i FROM {kind}_parts WHERE len(p) > 1)),
{kind}_spans AS (SELECT doc_id, '{kind}' AS kind, {KINDS.index(kind)} AS kind_no, s, s + length(m) AS e, {score} AS score FROM {kind}_at WHERE {ok}{enough})"""


_D = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_D}) + 1), lambda k: CASE WHEN (length({_D}) - k) % 2 = 0 THEN CAST({_D}[k] AS INT)
   ELSE CASE WHEN CAST({_D}[k] AS INT) > 4 THEN CAST({_D}[k] AS INT) * 2 - 9 ELSE CAST({_D}[k] AS INT) * 2 END END)) % 10 = 0"""
_T = "replace(m, ' ', '')"
_MOD97 = f"""CAST(list_reduce(list_prepend(0, list_transform(string_split({_T}[5:] || {_T}[1:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(ascii(c) - 48 AS INT) ELSE CAST(ascii(c) - 55 AS INT) END)),
   lambda a, x: CASE WHEN x < 10 THEN (a * 10 + x) % 97 ELSE (a * 100 + x) % 97 END) AS INT) = 1"""
OP4_SQL = (
    "WITH base AS (SELECT doc_id, replace(coalesce(text, ''), chr(57344), chr(57345)) AS t FROM documents),"
    + ",".join(
        (
            _duck("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
            _duck("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: CAST(x AS HUGEINT) > 255)) = 0"),
            _duck("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_D}) BETWEEN 12 AND 19 AND {_LUHN}"),
            _duck("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_D}) BETWEEN 9 AND 15"),
            _duck("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", _MOD97),
            _duck("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$')"),
            _duck("secret", r"[A-Za-z0-9+/_-]{20,}", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"),
        )
    )
    + """,
spans AS ("""
    + " UNION ALL ".join(f"SELECT * FROM {k}_spans" for k in KINDS)
    + """),
joined AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) AS listed, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no) FILTER (kind_no < 4) AS base_listed,
  string_agg(CAST(CAST(round(100 * score) AS INT) AS VARCHAR), ',' ORDER BY s, kind_no) AS scores, count(*) AS n_spans, """
    + ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)
    + """ FROM spans GROUP BY doc_id)
SELECT b.doc_id, """
    + ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)
    + """, sha256(coalesce(base_listed, '')) AS base_sha256, coalesce(listed, '') AS spans, coalesce(n_spans, 0) AS n_spans, coalesce(scores, '') AS score_pct
FROM base b LEFT JOIN joined j ON b.doc_id = j.doc_id"""
)
