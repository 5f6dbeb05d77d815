import re
from collections import Counter

from tests.llm import corpus
from vitarium.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


def test_measures_equal_a_plain_count(spark):
    found = quality.quality(corpus.frame(spark)).select("doc_id", *quality.COUNTS, "base_failed")
    want = sorted(((r[0], *brute(r[1])) for r in corpus.rows()), key=repr)
    assert corpus.rows_of(found) == want


def test_rules_reject_junk_and_keep_prose(spark):
    cases = {1: " ".join(f"the w{i}rd of house{i * 7} and" for i in range(20)), 2: " | ".join(f"word{i}" for i in range(80)),
             3: " ".join(f"SHOUT{i}!!" for i in range(80)), 4: "same line\n" * 60, 5: None, 6: ""}
    df = spark.createDataFrame(list(cases.items()), "doc_id bigint, text string")
    kept = {r.doc_id for r in quality.quality(df).collect() if r.kept}
    assert kept == {1}
    assert [r.doc_id for r in quality.passes(df).collect()] == [1]


def test_own_columns_pass_through(spark):
    df = corpus.frame(spark)
    assert quality.passes(df).columns == df.columns
    assert quality.quality(corpus.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality.quality(corpus.frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
