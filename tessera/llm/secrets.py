"""Secret scans in DataFrame expressions only.

Base kinds, each leftmost and non-overlapping: ``assign`` (a credential word, a separator and a value
of 6 or more characters), ``access`` (key ids) and ``hex`` (runs of 24 or more hexadecimal digits).
The scan adds ``entropy`` spans: candidate strings of 20 or more key characters in which some window of
20 characters reaches the Shannon entropy set for the candidate's character class. A window slides one
character at a time: the counts of the character that leaves and of the one that enters, kept in five bits
each of a few longs, change by one, and with them the running sum of n log2 n. Candidates that overlap a base span or match the allow list are suppressed.
Gates: a candidate holds a digit or letters of both cases; one without a digit must reach 3.9 bits, others
3.0 (hexadecimal), 3.6 (letters and digits) or 3.8; ``ALLOW`` names what is passed over, paths among it:
three segments of letters anywhere, or three at the start that hold no capital but their first sign. So
keys of letters of one case, and keys that stay under their bar in every window, get no entropy span.

Spans are code point offsets, end exclusive. Defined results: a null or empty text has no spans; every
row is scanned for itself, repeated rows and rows with a null id included; an empty table gives no rows;
other columns are left alone. Texts are scanned whole, in time linear in their length and in that of their
candidates but for the square root of the number of matches; there is no shuffle, so hot keys cost nothing.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: With a digit, or with letters of both cases.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9]|[+/_-]*(?:[a-z][a-z+/_-]*[A-Z]|[A-Z][A-Z+/_-]*[a-z]))[A-Za-z0-9+/_-]{20,}={0,2}"

WINDOW = 20
#: Least entropy, in bits, of some window, by character class; the first class that fits counts.
CLASSES = (("letters", r"^[A-Za-z+/_-]+={0,2}$", 3.9), ("hex", r"^[0-9a-fA-F]+$", 3.0), ("alnum", r"^[A-Za-z0-9]+$", 3.6), ("base64", r"", 3.8))
#: Candidates that are not secrets: numbers, UUIDs, placeholders, alphabets, and paths.
ALLOW = (
    r"^[0-9_/+-]+$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|(?i)example|sample|dummy|placeholder|changeme|redacted|test_?key|xxxx"
    r"|(?i)abcdefghij|0123456789|1234567890|(/[A-Za-z_-]{2,}){3}|(?-i)^(/[A-Z]?[a-z0-9_-]{2,}){3}"
)
ALPHABET = string.ascii_letters + string.digits + "+/_-"
KINDS = ("assign", "access", "hex", "entropy")
_SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def _scan(items: Column, first: Column, step, emit, kind: str) -> Column:
    """Array of ``emit(state, item)``, the state before each item being folded by ``step`` from ``first``.

    Arrays grow by copies, so the items go in blocks of about the square root of their number.
    """
    empty = F.array().cast(f"array<{kind}>")

    def block(items, state):
        return F.aggregate(
            items, F.struct(state.alias("s"), empty.alias("out")),
            lambda a, x: F.struct(step(a["s"], x).alias("s"), F.concat(a["out"], F.array(emit(a["s"], x))).alias("out")),
        )

    def over(items):
        size = F.greatest(F.ceil(F.sqrt(F.size(items))).cast("int"), F.lit(1))
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(items) / size).cast("int") - 1), lambda k: F.slice(items, k * size + 1, size))
        folded = F.aggregate(
            blocks, F.struct(first.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out")),
            lambda a, x: _bind(block(x, a["s"]), lambda y: F.struct(y["s"].alias("s"), F.concat(a["out"], F.array(y["out"])).alias("out"))),
            lambda a: F.flatten(a["out"]),
        )
        return F.when(F.size(items) > 0, folded).otherwise(empty)

    return _bind(items, over)


_MATCH = "struct<start:int,end:int,m:string,g:string>"


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, match, group) of all matches, from the lengths of the pieces around them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.transform(whole, lambda m: F.lit(None).cast("string"))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
    parts = F.filter(F.arrays_zip(gaps.alias("gap"), whole.alias("m"), groups.alias("g")), lambda x: x["m"].isNotNull())
    past = lambda at, x: at + x["gap"] + F.char_length(x["m"])
    walked = _scan(parts, F.lit(0), past, lambda at, x: F.struct((at + x["gap"]).alias("start"), past(at, x).alias("end"), x["m"].alias("m"), x["g"].alias("g")), _MATCH)
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(f"array<{_MATCH}>"))


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def max_entropy(word: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy of all windows of ``window`` characters; null for shorter words.

    ``window`` is at most 31. Characters other than those of ``ALPHABET`` count as one and the same.
    """
    bits, per = 5, 12
    longs = -(-(len(ALPHABET) + 1) // per)
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])

    def over(codes):
        def step(a, i):
            came, left = F.get(codes, i), F.coalesce(F.get(codes, F.when(i >= window, i - window)), F.lit(-1))
            one = lambda code: F.call_function("shiftleft", F.lit(1).cast("long"), bits * F.pmod(code, F.lit(per)))
            count = lambda counts, code: F.call_function("shiftright", F.get(counts, F.floor(code / per).cast("int")), bits * F.pmod(code, F.lit(per))).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
            gain = lambda n: F.get(table, n + 1) - F.get(table, n)
            less = F.when(left >= 0, F.transform(a["n"], lambda x, k: F.when(k == F.floor(left / per), x - one(left)).otherwise(x))).otherwise(a["n"])
            fell = F.when(left >= 0, a["s"] - gain(count(a["n"], left) - 1)).otherwise(a["s"])

            def enter(rest):
                total = rest["s"] + gain(count(rest["n"], came))
                more = F.transform(rest["n"], lambda x, k: F.when(k == F.floor(came / per), x + one(came)).otherwise(x))
                return _bind(total, lambda t: F.struct(more.alias("n"), t.alias("s"), F.when(i >= window - 1, F.least(a["low"], t)).otherwise(a["low"]).alias("low")))

            return _bind(F.struct(less.alias("n"), fell.alias("s")), enter)

        start = F.struct(F.array_repeat(F.lit(0).cast("long"), longs).alias("n"), F.lit(0.0).alias("s"), F.lit(1e9).alias("low"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda a: a["low"])

    codes = F.transform(F.split(word, ""), lambda c: F.coalesce(F.nullif(F.instr(F.lit(ALPHABET), c), F.lit(0)) - 1, F.lit(len(ALPHABET))))
    low = _bind(F.slice(codes, F.lit(1), F.char_length(word)), over)
    return F.when(F.char_length(word) >= window, F.lit(math.log2(window)) - low / window)


def _is_secret(word: Column) -> Column:
    least = F.lit(CLASSES[-1][2])
    for _, pattern, bits in reversed(CLASSES[:-1]):
        least = F.when(word.rlike(pattern), F.lit(bits)).otherwise(least)
    return ~word.rlike(ALLOW) & (F.coalesce(max_entropy(F.rtrim(word, F.lit("="))), F.lit(0.0)) >= least)


def _suppressed(base: Column, more: Column) -> Column:
    """The spans of candidates that overlap no base span and are secrets."""
    item = lambda m: lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("entropy")).alias("rank") if m else x["rank"], x["end"].alias("end"), x["m"].alias("m") if m else F.lit(None).cast("string").alias("m"))

    def over(items):
        is_base = lambda x: x["rank"] < KINDS.index("entropy")
        # A base span overlaps a candidate if one that begins no later ends after its start, or one that begins later begins before its end.
        before = _scan(items, F.lit(0), lambda s, x: F.when(is_base(x), F.greatest(s, x["end"])).otherwise(s), lambda s, x: s > x["start"], "boolean")
        after = F.reverse(_scan(F.reverse(items), F.lit(2**31 - 1), lambda s, x: F.when(is_base(x), F.least(s, x["start"])).otherwise(s), lambda s, x: s < x["end"], "boolean"))
        free = F.filter(F.arrays_zip(items.alias("x"), before.alias("b"), after.alias("a")), lambda z: ~is_base(z["x"]) & ~z["b"] & ~z["a"])
        return F.filter(F.transform(free, lambda z: z["x"]), lambda x: _is_secret(x["m"]))

    return _spans(_bind(F.array_sort(F.concat(F.transform(base, item(False)), F.transform(more, item(True)))), over), "entropy")


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, base (array of spans) and spans (with the entropy spans), by start."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    empty = F.array().cast(f"array<{_SPAN}>")
    at = docs.select(F.col("doc_id").alias("_id"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), text.alias("_text"))
    kept = [f"_k{i}" for i in range(len(keep))]
    at = at.select(
        "_id", *kept, _found(F.col("_text"), ASSIGN, 2).alias("_assign"), _found(F.col("_text"), ACCESS).alias("_access"),
        _found(F.col("_text"), HEX).alias("_hex"), _found(F.col("_text"), CANDIDATE).alias("_more"),
    )
    assign = F.filter("_assign", lambda x: F.char_length(x["g"]) >= 6)
    base = F.concat(_spans(assign, "assign"), _spans(F.col("_access"), "access"), _spans(F.col("_hex"), "hex"))
    at = at.select("_id", *kept, F.array_sort(base).alias("_base"), "_more")
    more = F.when(F.size("_more") > 0, _suppressed(F.col("_base"), F.col("_more"))).otherwise(empty)
    found = at.select("_id", *kept, "_base", more.alias("_more"))
    return found.select(F.col("_id").alias("doc_id"), *(F.col(k).alias(c) for k, c in zip(kept, keep)), F.col("_base").alias("base"), F.array_sort(F.concat("_base", "_more")).alias("spans"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), n("assign"), n("access"), n("hex"), F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans")
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``, spans that overlap by one; n_chars, where it is a column, follows the text."""
    names = docs.columns
    at = docs.select(F.col("doc_id"), "text", F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("_row"))
    found = find_secrets(at, ("text", "_row"))
    # What lies between the spans, where a span does not begin inside an earlier one, and after the last one.
    gap = lambda end, start: F.struct(end.alias("a"), start.alias("b"))
    gaps = _scan(F.col("spans"), F.lit(0), lambda end, s: F.greatest(end, s["end"]), lambda end, s: F.when(s["start"] >= end, gap(end, s["start"])), "struct<a:int,b:int>")
    last = gap(F.array_max(F.transform("spans", lambda s: s["end"])), F.char_length("text"))

    def pieces(gaps):
        # A substring is sought from the beginning of its text, so that is cut into blocks of gaps first.
        size = F.ceil(F.sqrt(F.size(gaps))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(gaps) / size).cast("int") - 1), lambda k: F.slice(gaps, k * size + 1, size))
        first = lambda block: F.get(block, 0)["a"]
        part = lambda block: F.substring(F.col("text"), first(block) + 1, F.element_at(block, -1)["b"] - first(block))
        cut = lambda block: _bind(part(block), lambda t: F.transform(block, lambda g: F.substring(t, g["a"] - first(block) + 1, g["b"] - g["a"])))
        return F.flatten(F.transform(blocks, cut))

    between = _bind(F.concat(F.filter(gaps, lambda g: g.isNotNull()), F.array(last)), pieces)
    marked = F.when(F.size("spans") > 0, F.array_join(between, mark))
    out = found.select("_row", marked.alias("_marked"))
    column = lambda i, c: F.col(f"_row.c{i}")
    kind = {"text": F.col("_marked"), "n_chars": F.char_length("_marked")}
    return out.select(*[
        (F.coalesce(kind[c].cast(docs.schema[c].dataType), column(i, c)) if c in kind else column(i, c)).alias(c) for i, c in enumerate(names)
    ])
