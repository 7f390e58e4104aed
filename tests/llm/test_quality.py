import math
import re
from collections import Counter

from newsroster.llm.quality import judge, ratio_table


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n)


def test_measures(odd, docs, spark):
    more = docs((20, "a b c a b c a b c d\n\nx\nx \nx\n#|<"), (21, "a a a a"), (22, "a b a b a"),
                (23, " ".join(str(i % 70) for i in range(100))))
    rows = odd.unionByName(more)
    got = judge(rows, spark.range(0).withColumnRenamed("id", "doc_id")).collect()
    want = sorted(brute(r.text) for r in rows.collect())
    assert sorted(tuple(r)[1:7] for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # nothing trusted: the rules decide
    assert judge(rows.limit(0), rows).collect() == []


def test_ratio_is_the_mean_of_the_table(docs, spark):
    good, bad = "alpha beta gamma delta " * 20, "zzz yyy xxx www vvv " * 20
    numbered = [(i, " ".join(w + str(i * j % 13) for j, w in enumerate((good, bad)[i % 2].split())))
                for i in range(40)]
    df = docs(*numbered)
    trusted = df.where("doc_id % 2 = 0").select("doc_id")
    got = {r.doc_id: r for r in judge(df, trusted, least_ratio=0.0).collect()}
    assert all(got[i].ratio > 0 if i % 2 == 0 else got[i].ratio < 0 for i in got)
    assert all(r.kept == (not r.base_failed and r.ratio >= 0) for r in got.values())
    table = ratio_table(df, trusted, buckets=64)
    assert len(table) == 64 and all(math.isfinite(x) for x in table)
