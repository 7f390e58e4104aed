import hashlib

from pyspark.sql import functions as F

from newsroster.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def brute(rows, largest):
    def norm(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")

    best = max if largest else min
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    found = set()
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = best(ids) if ids else None
        found.add((i, keep, len(groups[norm(t)]), i == keep,
                   hashlib.sha256(norm(t).encode()).hexdigest()))
    return found


def check(df, largest, **options):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = exact_duplicates(df, largest=largest, **options).collect()
    assert len(got) == len({tuple(r)[:5] for r in got})
    assert {tuple(r)[:5] for r in got} == brute(rows, largest)
    assert sum(r.n_rows for r in got) == len(rows)


def test_against_brute_force(odd):
    check(odd, True)
    check(odd, False)


def test_colliding_hashes_are_told_apart(odd):
    check(odd, True, hashed=lambda t: F.unhex(F.hex(F.length(t) % 3)))


def test_empty(odd):
    assert exact_duplicates(odd.limit(0)).collect() == []


def test_kept_rows_have_their_columns(odd):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id or 0, r.text or "") for r in kept.select("doc_id", "text").collect())
    assert [i for i, _ in ids] == [0, 1, 1, 2, 3, 5, 6]
