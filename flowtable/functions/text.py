"""Column-level text helpers (all JVM-side expressions)."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Line terminators recognised by a buffered line reader: CRLF, LF, CR.
LINE_BREAK = r"\r\n|\n|\r"


def text_lines(text: Column) -> Column:
    """Lines of a text the way a buffered line reader yields them: no final
    empty line after a trailing terminator; an empty text has no lines."""
    # texts without CR split on the single LF character (a plain scan, no regex)
    parts = F.when(text.contains("\r"), F.split(text, LINE_BREAK, -1)).otherwise(F.split(text, "\n", -1))
    return let(parts, lambda p: F.when(F.element_at(p, -1) == F.lit(""), F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def java_regex_groups(spark: SparkSession, regex: str) -> int:
    """Validate ``regex`` in the JVM's dialect (the one Spark uses) and return
    its number of capturing groups. Raises ``ValueError`` when invalid.

    Without a JVM handle (e.g. a remote session) the ``regex`` module, which
    reads the same class and group syntax for common patterns, stands in."""
    try:
        jvm = spark.sparkContext._jvm
        pattern = jvm.java.util.regex.Pattern
    except Exception:  # no local JVM gateway
        import regex as pyregex

        try:
            return int(pyregex.compile(regex).groups)
        except pyregex.error as exc:
            raise ValueError(f"invalid regex {regex!r}: {exc}") from None
    try:
        return int(pattern.compile(regex).matcher("").groupCount())
    except Exception as exc:  # py4j wraps PatternSyntaxException
        raise ValueError(f"invalid regex {regex!r}: {exc}") from None


def first_group(regex: str) -> str | None:
    """The pattern text inside capture group 1, or None without one."""
    i, start, depth, in_class = 0, None, 0, 0
    while i < len(regex):
        c = regex[i]
        if regex.startswith("\\Q", i):  # quoted up to \E
            end = regex.find("\\E", i)
            i = len(regex) if end < 0 else end + 2
            continue
        if c == "\\":
            i += 2
            continue
        if c == "[":
            in_class += 1
        elif c == "]" and in_class:
            in_class -= 1
        elif c == "(" and not in_class:
            named = re.match(r"\(\?<[A-Za-z][A-Za-z0-9]*>", regex[i:])
            if start is None and (not regex.startswith("(?", i) or named):
                start, depth = i + (named.end() if named else 1), 0
            elif start is not None:
                depth += 1
        elif c == ")" and not in_class and start is not None:
            if depth == 0:
                return regex[start:i]
            depth -= 1
        i += 1
    return None


def group_may_be_empty(spark: SparkSession, regex: str) -> bool:
    """Whether capture group 1 can match the empty string (asked of the JVM's
    regex engine). A group with look-around or anchors counts as one that can."""
    inner = first_group(regex)
    if inner is None or re.search(r"\(\?[=!<]|\\[bBAGZz]|[\^$]|\\[1-9]", inner):
        return True
    try:
        return bool(spark.sparkContext._jvm.java.util.regex.Pattern.matches(f"(?:{inner})", ""))
    except Exception:  # no JVM handle, or the part does not stand alone
        import regex as pyregex

        try:
            return pyregex.fullmatch(f"(?:{inner})", "") is not None
        except pyregex.error:
            return True


def regex_is_valid(spark: SparkSession, regex: str) -> bool:
    try:
        java_regex_groups(spark, regex)
        return True
    except ValueError:
        return False


def word_count(text: Column) -> Column:
    """Words separated by white space of any kind; 0 for blank text."""
    return F.regexp_count(text, F.lit(r"\S+"))
