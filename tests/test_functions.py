import pytest
from pyspark.sql import functions as F

from evidra.functions import diff as D
from evidra.functions import text as X


@pytest.mark.parametrize(
    "before, patch, after",
    [
        ("a\nb\nc\n", "@@ -2,1 +2,1 @@\n-b\n+B\n", "a\nB\nc\n"),
        ("", "@@ -0,0 +1,2 @@\n+x\n+y\n", "x\ny\n"),
        ("a\n", "@@ -1 +0,0 @@\n-a\n", ""),
        ("a\nb", "--- x\n+++ y\n@@ -1,2 +1,2 @@\n a\n-b\n\\ No newline at end of file\n+c\n\\ No newline at end of file\n", "a\nc"),
        ("1\n2\n3\n4\n5\n6\n", "@@ -1,1 +1,2 @@\n 1\n+1b\n@@ -5,2 +6,1 @@\n-5\n 6\n", "1\n1b\n2\n3\n4\n6\n"),
    ],
)
def test_diffs_that_apply(before, patch, after):
    assert D.apply_diff(before, patch) == after


@pytest.mark.parametrize(
    "before, patch, error",
    [
        ("a\n", "hello\n", D.E_HEAD), ("a\n", "", D.E_NONE), ("a\n", "@@ -1,1 +1,1 @@\n-x\n+y\n", D.E_CONTEXT), ("a\n", "@@ -1,1 +5,1 @@\n-a\n+y\n", D.E_NEW),
        ("a\n", "@@ -9,1 +9,1 @@\n-a\n+y\n", D.E_RANGE), ("a\n", "@@ -1,2 +1,1 @@\n-a\n+y\n", D.E_COUNT), ("a\n", "@@ -1,1 +1,1 @@\n*a\n", D.E_BODY),
    ],
)
def test_diffs_that_do_not(before, patch, error):
    with pytest.raises(D.DiffError, match=error):
        D.apply_diff(before, patch)


def test_made_diffs_apply():
    import random

    r = random.Random(1)
    for _ in range(200):
        a = "".join(r.choice("xyz") + r.choice(["\n", "\n", ""]) for _ in range(r.randrange(12)))
        b = "".join(r.choice("xyz") + r.choice(["\n", "\n", ""]) for _ in range(r.randrange(12)))
        if a != b:
            assert D.apply_diff(a, D.make_diff(a, b)) == b


def test_symbols():
    got = D.inspect_code("pkg/a.py", "from .b import g as h\nimport os\nclass A:\n    def f(self):\n        return h(os.getcwd())\n")
    assert [s["name"] for s in got["symbols"]] == ["A", "A.f"] and got["imports"] == {"h": {"module": "b", "level": 1, "name": "g"}}
    assert [(r["from"], r["expression"], r["simple_name"]) for r in got["references"]] == [("A.f", "h", "h"), ("A.f", "os.getcwd", None)]
    assert D.inspect_code("a.py", "def (")["status"] == "parse_error" and D.inspect_code("a.js", "x")["status"] == "unsupported_language"


def column(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).head().r


def test_tokens_and_ngrams(spark):
    assert column(spark, "Use src/App.py now，修改配置 x", X.tokens) == ["use", "src/app.py", "now", "修改配置", "x"]
    assert column(spark, None, X.tokens) == []
    assert sorted(column(spark, " A  bCd ", X.ngrams)) == [" bc", "a b", "bcd"] and column(spark, "ab", X.ngrams) == ["ab"] and column(spark, "", X.ngrams) == []
    assert column(spark, "x > 0", X.normalized) == "x > 0" and column(spark, None, X.normalized) == ""


@pytest.mark.parametrize("text, secret", [("password = hunter2", True), ("password = <secret>", False), ("token: os.environ['X']", False), ("api_key=$KEY", False), ("Bearer abcdefghijkl", True), ("https://u:p@host/x", True), ("sk-aaaaaaaaaaaaaaaaaaaa", True), ("密码是 abc123", True), ("just words", False), (None, False), ("-----BEGIN RSA PRIVATE KEY-----", True)])
def test_credentials(spark, text, secret):
    assert column(spark, text, X.credential_detected) is secret


def test_redaction(spark):
    assert column(spark, "set password=abc now", X.redact_assignments) == "set <credential assignment omitted> now"
    got = column(spark, "see /home/ann/x.py, /work/app/y and https://h/home/ann/z or e12", lambda c: X.redact_paths(c, ["/work/app"]))
    assert got == "see ~/x.py, <workspace>/y and https://h/home/ann/z or 该条记录"


def test_small_parsers(spark):
    assert column(spark, "A1=supported@e1,e2; F1=contradicted@e3", X.assignments) == {"A1": "supported@e1,e2", "F1": "contradicted@e3"}
    assert column(spark, "A1=x;A1=y", X.assignments) is None and column(spark, "A1", X.assignments) is None
    assert column(spark, "e1, none, -, e2", X.csv_tokens) == ["e1", "e2"]
    assert column(spark, "RESULT: a\nx\nRESULT: b", lambda c: X.key_values(c, ["RESULT", "OTHER"])) == {"RESULT": "b", "OTHER": None}
    assert column(spark, "之前失败，后来修复 must", lambda c: X.labels(c, X.FACT_LABELS)) == ["constraint", "failure", "temporal"]
    assert column(spark, "src/a/b.py uses parser.Core and e12", X.entities) == ["uses", "parser.core", "and"]
    assert column(spark, "/w/app\\x\\y.py", lambda c: X.normalize_path(c, F.lit("/w/app/"))) == "x/y.py"
