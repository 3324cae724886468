"""Text expressions: Column in, Column out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space at the ends of a text.
EDGE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Parts of an error message that report a captcha (fixed values).
CHALLENGES = ("reCaptcha", "Captcha")
#: The name that stands first in the header of a saved text (fixed value).
COURT = "Danıştay"


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(text, F.lit(EDGE))


def has_content(text: Column) -> Column:
    """Whether anything is left of a text without white space at its ends; stops at the first such sign."""
    return text.rlike("[^" + "".join(f"\\x{{{ord(c):x}}}" for c in EDGE) + "]")


def collapse_breaks(text: Column) -> Column:
    """Three or more line feeds become two."""
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def none_if_null(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def header(text: Column, chamber: Column, case_no: Column, decision_no: Column, date: Column) -> Column:
    """A saved text: a line with the decision's particulars, a rule of 60 signs, the text, and a line feed."""
    parts = [F.lit(f"{COURT} | "), none_if_null(chamber), F.lit(" | E:"), none_if_null(case_no), F.lit(" K:"), none_if_null(decision_no), F.lit(" T:"), none_if_null(date)]
    return F.concat(*parts, F.lit("\n" + "=" * 60 + "\n"), text, F.lit("\n"))


def wait_label(seconds: Column) -> Column:
    """Whole hours from 3600 s, whole minutes from 60 s, else seconds."""
    whole = lambda n: F.floor(seconds / n).cast("string")
    return F.when(seconds >= 3600, F.concat(whole(3600), F.lit("h"))).when(seconds >= 60, F.concat(whole(60), F.lit(" min"))).otherwise(F.concat(seconds.cast("string"), F.lit("s")))


def url_quote(text: Column) -> Column:
    """Percent-encoding of UTF-8 that leaves letters, digits and ``_.-~/`` alone; an empty or null text is one space."""
    quoted = F.url_encode(F.coalesce(F.nullif(text, F.lit("")), F.lit(" ")))
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        quoted = F.replace(quoted, F.lit(old), F.lit(new))
    return quoted


def is_challenge(message: Column) -> Column:
    """Whether an error message reports a captcha."""
    return F.coalesce(reduce(lambda a, b: a | b, (message.contains(c) for c in CHALLENGES)), F.lit(False))


def has_words(text: Column, words: list[str], how: str = "all") -> Column:
    """Whether a text holds all (or any) of the words as whole tokens, whatever their case."""
    edge, tests = r"[\p{L}\p{N}]", []
    for word in words:
        quoted = word.replace("\\E", r"\E\\E\Q")
        tests.append(text.rlike(rf"(?iu)(?<!{edge})\Q{quoted}\E(?!{edge})"))
    return reduce(lambda a, b: a & b if how == "all" else a | b, tests)


def settings(text: Column) -> Column:
    """The map of key=value lines; the first line of a key counts, its value is all after the first sign."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.contains("="))
    names = F.array_distinct(F.transform(lines, lambda x: F.substring_index(x, "=", 1)))
    value = lambda k: F.get(F.filter(lines, lambda x: F.substring_index(x, "=", 1) == k), 0)
    return F.map_from_arrays(names, F.transform(names, lambda k: F.substr(value(k), F.char_length(k) + 2)))


def host_port(address: Column) -> Column:
    """(host, port) of ``host:port``."""
    return F.struct(F.substring_index(address, ":", 1).alias("host"), F.substring_index(address, ":", -1).cast("int").alias("port"))
