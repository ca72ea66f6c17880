"""The rules' regex dialect: what each pattern must match, as a whole."""

import pytest
from pyspark.sql import functions as F

from seriesship.functions.regex import translate
from seriesship.operators.relabel import Rule, anchored, check_rules

# pattern: texts that match, texts that do not
GOLDEN = {
    "[[:alpha:]]+": (["abc", "lap"], ["123", "a:l", ""]),
    "[^[:alpha:]]+": (["123", ":"], ["a1"]),
    "[[:^digit:]x]+": (["abc", "x"], ["1"]),
    r"[^[:^digit:]]+": (["12"], ["a"]),
    r"\pL+": (["né", "Ж"], ["1"]),
    r"\p{L}+": (["né"], ["-"]),
    r"\P{L}+": (["12"], ["a"]),
    r"\p{Greek}+": (["αβ"], ["ab"]),
    r"\p{^Greek}+": (["ab"], ["αβ"]),
    r"[\pN_]+": (["1_٣"], ["a"]),
    r"a\*+": (["a*", "a**"], ["a"]),
    "[a&&b]+": (["a&b"], ["c"]),
    "[a[b]+": (["a[b"], ["]"]),
    "[]a]+": (["]a"], ["["]),
    "[a-]+": (["a-"], ["b"]),
    r"[\]\-\\^]+": ([r"]-\^"], ["a"]),
    r"\s": (["\t", " "], ["\x0b", "a"]),
    r"[\s]": (["\t"], ["\x0b"]),
    r"[\S1]+": (["a\x0b"], [" "]),
    r"a.c": (["abc", "a\nc", "a c"], ["ac"]),
    r"(?-s)a.c": (["abc", "a\rc", "a c"], ["a\nc"]),
    r"(?-s:a.)c.": (["abc\n"], ["a\ncx"]),
    r"a$|b": (["a", "b"], ["a\n"]),
    r"(?m)a$\n^b": (["a\nb"], ["ab"]),
    r"\bab\b": (["ab"], ["abc"]),
    r"é\b.*": (["éa"], ["éé"]),
    r"(?i)straSSe|k": (["STRASSE", "K", "K"], ["x"]),
    r"(?i:a)b": (["Ab"], ["AB"]),
    r"(?P<one_1>a)(?<two>b)": (["ab"], ["a"]),
    r"\Qa.b*\E+": (["a.b*", "a.b**"], ["axb"]),
    r"a{2,3}": (["aa", "aaa"], ["a"]),
    r"a{,2}": (["a{,2}"], ["aa"]),
    r"{a}": (["{a}"], ["a"]),
    r"\x41\x{1F600}\101\07": (["A\U0001f600A\x07"], ["A"]),
    r"\_\-\/": (["_-/"], ["a"]),
    "": ([""], ["a"]),
    "a||b": (["a", "", "b"], ["ab"]),
    "x*?y+?": (["y", "xyy"], ["x"]),
}
REFUSED = [
    r"(a)\1", "(?=a)", "(?!a)", "(?<=a)b", "(?<!a)b", "(?>a)", "a++", "a**", "*a", "(*a)", "a|*", "(a", "a)", "[a", "[b-a]",
    r"\Z", r"\C", r"\y", "a{1001}", "a{3,2}", r"\pQ1", "[[:nope:]]", "(?U)a", "(?<n>a)(?<n>b)", "\\", r"\x{110000}", r"[a-\d]",
]


def test_golden(spark):
    rows = [(p, t, t in yes) for p, (yes, no) in GOLDEN.items() for t in (*yes, *no)]
    for pattern in GOLDEN:
        df = spark.createDataFrame([r for r in rows if r[0] == pattern], "p string, t string, want boolean")
        got = df.select("t", "want", F.col("t").rlike(anchored(pattern)).alias("got")).collect()
        assert [r["got"] for r in got] == [r["want"] for r in got], pattern


@pytest.mark.parametrize("pattern", REFUSED)
def test_refused(pattern):
    with pytest.raises(ValueError):
        check_rules([Rule("keep", ("a",), regex=pattern)])


def test_groups():
    t = translate(r"(a)(?:b)(?P<x>c)((?i)d)")
    assert (t.groups, t.names) == (3, {"x": 2})
