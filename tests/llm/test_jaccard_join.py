import random

import pytest

from newsroster.llm.jaccard_join import _among, drop_near_duplicates, near_duplicates, prefix_length


def brute(rows, width, percent):
    sets = []
    for i, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = low.encode().split()
        sets.append({tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]) or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(sets[k]), least.get(root(k)) if i is not None else None)
                   for k, (i, _) in enumerate(rows)), key=str)


def check(df, width, percent):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, near_duplicates(df, width=width, percent=percent).collect()), key=str)
    assert got == brute(rows, width, percent)


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        k = draw.randrange(len(words))
        kind = draw.random()
        if kind < 0.5:
            words[k] = f"e{draw.randrange(10 ** 6)}"
        elif kind < 0.8:
            del words[k]
        else:
            words.insert(k, f"i{draw.randrange(10 ** 6)}")
    return words


@pytest.mark.parametrize("seed,width,percent", [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_components(docs, seed, width, percent):
    """Clusters with chains of edits, shared passages, copies and short texts."""
    draw = random.Random(seed)
    texts, passage = [], [f"p{k}" for k in range(30)]
    for c in range(8):
        base = [f"w{draw.randrange(300)}" for _ in range(draw.randint(3, 90))]
        for _ in range(8):
            texts.append(" ".join(base))
            base = edited(draw, base, draw.randint(0, 3)) or ["z"]
    for _ in range(12):
        own = [f"u{draw.randrange(10 ** 6)}" for _ in range(draw.randint(0, 40))]
        texts.append(" ".join(own + passage))
    texts += [texts[0].upper(), texts[0], "one", "one two", "One", "two one", "", None, " \n"]
    draw.shuffle(texts)
    check(docs(*enumerate(texts)), width, percent)


def test_links_inside_a_group(docs):
    """Sets of equal prefix and size whose prefix no other group has; most of them are far apart."""
    draw = random.Random(5)
    pool, texts = [f"p{k}" for k in range(120)], []
    for c in range(5):
        rare = [f"r{c}x{k}" for k in range(7)]
        tails = [draw.sample(pool, 33) for _ in range(6)]
        tails.append(tails[0][1:] + draw.sample(sorted(set(pool) - set(tails[0])), 1))
        texts += [" ".join(rare + tail) for tail in tails]
    texts += [" ".join(draw.sample(pool, 60)) for _ in range(20)]
    check(docs(*enumerate(texts)), 1, 85)


def test_odd_rows(odd):
    check(odd, 4, 85)
    assert near_duplicates(odd.limit(0)).collect() == []


def test_prefix_reaches_every_partner():
    for percent in (50, 80, 85, 100):
        for n in range(1, 200):
            # The least overlap with any partner is that with a subset.
            least = -(-percent * n // 100)
            assert prefix_length(n, percent) == n - least + 1


def test_one_of_each_group_stays(docs):
    text = " ".join(f"w{k}" for k in range(60))
    rows = docs((5, text), (3, text + " x"), (9, text.upper()), (1, "other words here"), (None, text), (2, ""))
    kept = drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3]


def test_the_filter_of_ids_is_no_part_of_the_plan(spark):
    """A plan with the filter as a literal is some 100 kB, and the driver holds many of its texts."""
    ids = spark.range(0, 40_000, 2)
    kept = _among(spark.range(80_000).selectExpr("id", "'x' AS t"), "id", ids)
    assert len(kept._jdf.queryExecution().toString()) < 10_000
    found = {r.id for r in kept.collect()}
    assert kept.columns == ["id", "t"] and found >= set(range(0, 40_000, 2)) and len(found) < 30_000
