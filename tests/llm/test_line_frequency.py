"""Operator 12 against a plain count of lines."""

import re
from collections import defaultdict

import pytest

from tarmac.llm import common, line_frequency

LICENSE = "All rights   RESERVED 1999, see the license."
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def body(i, n=60):
    return " ".join(str(i * 10_000 + j).translate(str.maketrans("0123456789", "abcdefghij")) for j in range(n))


def rows():
    out = [(i, f"{body(i)}\n{LICENSE.replace('1999', str(i))}", "a") for i in range(30)]
    out += [(100 + i, "copied text " + body(700) + "\ncopied end", "a") for i in range(200)]  # one document, however often
    out += [(400 + i, f"{body(400 + i, 5)}\n" + "\n".join(f"menu entry {k} of the page with many more words here" for k in range(8)), "a") for i in range(25)]
    out += [(500, "menu entry 3 of the page with many more words here\n" + body(500), "b"), (None, None, None), (None, "", "a"), (1, "\n \n\t", "a"), (1, body(1) + "\n" + LICENSE, "a")]
    return out


def plain(rows, min_docs, share):
    norm = lambda x: re.sub(r"[\x20\x09\x0B-\x0D]+", " ", re.sub("[0-9]+", "0", x.lower())).strip(" ")
    texts, holds = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        texts[s].add(t or "")
        for x in (t or "").split("\n"):
            if WORDS.search(x):
                holds[s, norm(x)].add(t or "")
    above = {k for k, v in holds.items() if len(v) > min_docs and len(v) > share * len(texts[k[0]])}
    for i, t, s in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not (WORDS.search(x) and (s, norm(x)) in above)]
        w = WORDS.findall(t or "")
        lost = len(w) - sum(len(WORDS.findall(x)) for x in left)
        windows = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        many = {x for x in windows if windows.count(x) > 1} if len(set(windows)) < len(windows) else set()
        repeated = len({j + k for j, x in enumerate(windows) if x in many for k in range(3)})
        failed = len(w) < 50 or 100 * repeated > 50 * len(w)
        yield i, s, len(w), repeated, failed, len(lines) - len(left), lost, not failed and 2 * lost <= len(w), "\n".join(left)


@pytest.mark.parametrize("heavy", [100_000, 3])
def test_lines_above_the_limits(spark, monkeypatch, heavy):
    monkeypatch.setattr(line_frequency, "HEAVY", heavy)
    common.shipped(spark)
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "7 AS host", "8 AS digest", "9 AS w")
    got = line_frequency.quality_rules(docs, min_docs=20, host_share=0.05)
    assert got.columns[:6] == ["doc_id", "text", "source", "host", "digest", "w"]
    names = ["doc_id", "source", "n_words", "n_repeat_words", "base_failed", "n_lines_removed", "n_words_removed", "kept", "kept_text"]
    got = sorted((tuple(r) for r in got.select(*names).collect()), key=str)
    assert got == sorted(plain(rows(), 20, 0.05), key=str)
    kept = {r[0] for r in got if r[7]}
    assert set(range(30)) | set(range(100, 300)) | {500} <= kept and not kept & set(range(400, 425))


def test_repeated_windows(spark):
    texts = ["a b c a b c", "a b", "a a a a", "x y z q x y z w", "", "p q r s t u v", "a b a b a b a"]
    df = spark.createDataFrame([(t, t.split()) for t in texts], "t string, w array<string>")
    got = {r.t: r.n for r in line_frequency.repeated_words(df, "n").collect()}
    assert got == {"a b c a b c": 6, "a b": 0, "a a a a": 4, "x y z q x y z w": 6, "": 0, "p q r s t u v": 0, "a b a b a b a": 7}


def test_no_python_worker_in_the_plan(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    plan = line_frequency.quality_rules(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
