"""n-th match over lines, nested detection and extraction."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from flowtable.functions.text import first_group
from flowtable.operators.extract import extract_to, nested_detect, nth_match


def brute_nth(text, regex, k, group):
    """Straight model of the per-line counter: the counter starts at 1, a match
    while counter == k sets the value (later matches on that line overwrite),
    other matches increment; reading stops after the line that set a value."""
    if text is None:
        return False, None
    lines = re.split(r"\r\n|\n|\r", text)
    if lines and lines[-1] == "":
        lines = lines[:-1]
    counter = 1
    for line in lines:
        value = None
        for m in re.finditer(regex, line):
            if counter == k:
                value = m.group(1) if group else line
            else:
                counter += 1
        if value is not None:
            return True, value
    return False, None


def run(spark, rows, regex, k, group=True):
    df = spark.createDataFrame(list(enumerate(rows)), "id long, text string")
    out = nth_match(df, ["id"], "text", regex, k, group).orderBy("id").collect()
    return [(r.found, r.value, r.route) for r in out]


def test_several_matches_on_one_line_last_wins(spark):
    text = "a1 a2\na3 a4 a5\na6"
    assert run(spark, [text], r"a(\d)", 3) == [(True, "5", "success")]
    assert run(spark, [text], r"a(\d)", 3, group=False) == [(True, "a3 a4 a5", "success")]
    assert run(spark, [text], r"a(\d)", 6) == [(True, "6", "success")]
    assert run(spark, [text], r"a(\d)", 7) == [(False, None, "success")]


def test_k_not_positive_never_matches(spark):
    assert run(spark, ["a1 a2"], r"a(\d)", 0) == [(False, None, "success")]
    assert run(spark, ["a1 a2"], r"a(\d)", -2) == [(False, None, "success")]


def test_line_breaks_crlf_cr_and_trailing(spark):
    assert run(spark, ["x\r\ny a1\r\na2 a3"], r"a(\d)", 2) == [(True, "3", "success")]
    assert run(spark, ["a1\ra2"], r"a(\d)", 2) == [(True, "2", "success")]
    assert run(spark, ["a1\n"], r"a(\d)", 1, group=False) == [(True, "a1", "success")]
    # an empty text has no lines; a lone newline is one empty line
    assert run(spark, [""], "x*", 1, group=False) == [(False, None, "success")]
    assert run(spark, ["\n"], "x*", 1, group=False) == [(True, "", "success")]


def test_zero_length_matches_count(spark):
    # 'x*' finds an empty match at 0, 1 and 2 in "ab"
    assert run(spark, ["ab"], "x*", 3, group=False) == [(True, "ab", "success")]
    assert run(spark, ["ab"], "x*", 4, group=False) == [(False, None, "success")]


def test_missing_group_and_invalid_regex(spark):
    assert run(spark, ["a1 a2"], r"a\d", 1, group=True) == [(False, None, "success")]
    assert run(spark, ["a1 a2"], "(", 1) == [(False, None, "failure")]


def test_null_text(spark):
    assert run(spark, [None], r"a(\d)", 1) == [(False, None, "success")]


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab1 \n\r", max_size=30), min_size=1, max_size=8),
       k=st.integers(min_value=-1, max_value=7), group=st.booleans())
def test_matches_brute_force(spark, texts, k, group):
    regex = r"a(b*)1" if group else r"ab*1"
    got = run(spark, texts, regex, k, group)
    want = [brute_nth(t, regex, k, group) for t in texts]
    assert [(f, v) for f, v, _ in got] == want


def test_nested_detect_chain_uses_last_crop(spark):
    df = spark.createDataFrame([(1, "Alpha thin thorn. Beta then that."), (2, "nothing here")], "id long, text string")
    defs = [{"name": "sentence", "pattern": "[A-Z][^.]*[.]", "crop": "true",
             "children": [{"name": "word", "pattern": "th[a-z]+"}, {"name": "tail", "pattern": "[a-z]+$"}]}]
    rows = {(r.id, r.path, r.ordinal): (r.content, r.route) for r in nested_detect(df, "id", "text", defs).collect()}
    assert rows[(1, "sentence", 1)] == ("Alpha thin thorn.", "success")
    assert rows[(1, "sentence", 2)] == ("Beta then that.", "success")
    # children run on the last sentence only
    assert rows[(1, "sentence/word", 1)] == ("then", "success")
    assert rows[(1, "sentence/word", 2)] == ("that", "success")
    # the chain: 'tail' runs on the input of 'word' (word does not crop)
    assert (1, "sentence/tail", 1) not in rows
    # no sentence in row 2: the children run on the input; 'tail' finds 'here'
    assert rows[(2, "sentence/tail", 1)] == ("here", "success")


def test_nested_detect_no_detection_route(spark):
    df = spark.createDataFrame([(1, "zzz")], "id long, text string")
    out = nested_detect(df, "id", "text", [{"name": "w", "pattern": "th[a-z]+"}]).collect()
    assert [(r.id, r.name, r.route) for r in out] == [(1, None, "no_object_detected")]


def test_extract_to_attribute_and_content(spark):
    df = spark.createDataFrame([(1, "call 555-1234 now"), (2, "no number")], "id long, text string")
    a = {r.id: (r.phone, r.route) for r in extract_to(df, "text", "[0-9]{3}-[0-9]{4}", attribute="phone").collect()}
    assert a == {1: ("555-1234", "success"), 2: (None, "failure")}
    c = {r.id: (r.text, r.route) for r in extract_to(df, "text", "[0-9]{3}-[0-9]{4}", destination="content").collect()}
    assert c == {1: ("555-1234", "success"), 2: ("no number", "failure")}


def test_unmatched_group_gives_no_value(spark):
    def run(text, regex, k):
        row = nth_match(spark.createDataFrame([(1, text)], "id int, t string"), ["id"], "t", regex, k).first()
        return row.found, row.value

    assert run("ab\nxb", "(a)?b", 1) == (True, "a") and run("ab\nxb", "(a)?b", 2) == (False, None)
    assert run("ab b ab", "(a)?b", 1) == (False, None)  # a later match on the line has no group
    assert run("b ab", "(a)?b", 2) == (True, "a") and run("b ab", "(a)?b", 1) == (False, None)
    assert run("xb", "(a*)b", 1) == (True, "")  # a group that matched nothing is a value
    assert run("c", "(a)|c", 1) == (False, None) and run("b", "(?<n>a)?b", 1) == (False, None)


def test_first_group():
    assert [first_group(r) for r in (r"a(b(c)d)e", r"\((x)", r"[(](?:y)(z)", r"(?i)abc", r"\Q(q\E(r)", r"(?<n>s)")] == \
        ["b(c)d", "x", "z", None, "r", "s"]
