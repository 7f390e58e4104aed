import hashlib
import random
import re

from newsroster.llm.secrets import BASE, digest, find_secrets, ratio_table


def brute(text):
    found = []
    for k, (kind, pattern) in enumerate(
            [("assign", BASE["assign"][0]), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")]):
        for m in re.finditer(pattern, text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                found.append((m.start(), k, m.end()))
    names = list(BASE)
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans(odd, docs):
    cases = [
        'é😀 token = "abcdefgh1" PASSWORD:short secret=secret:longenough1', "Api_Key=1234567",
        "AKIAAKIA1234567890 AKIASHORT xAKIA0123456789AB", "0123456789abcdef" * 3 + "G" + "f" * 31,
        "token=" + "a1" * 40, "passwd'  :  'x.y/z+w=-_1'", "secret==aaaaaaaaaa", "token =\tabcdefghi"]
    rows = odd.unionByName(docs(*[(100 + i, c) for i, c in enumerate(cases)]))
    got = digest(find_secrets(rows)).collect()
    want = sorted(hashlib.sha256(brute(r.text).encode()).hexdigest() for r in rows.collect())
    assert sorted(r.base_sha256 for r in got) == want
    assert digest(find_secrets(rows.limit(0))).collect() == []


def test_random_runs_are_added_and_words_are_not(docs):
    draw = random.Random(3)
    key = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    words = ["reading", "station", "internal", "relation", "another", "thinking", "landing"]
    rows = [(i, f'{" ".join(draw.choices(words, k=30))} token = "{key(40)}"') for i in range(200)]
    rows += [(500, "x " + key(40).upper() + " y"), (501, "stationrelationanotherthinking end")]
    got = {r.doc_id: r for r in digest(find_secrets(docs(*rows))).collect()}
    assert got[500].spans == "random:2:42" and got[501].spans == ""
    assert "random" not in got[0].spans and got[0].n_assign == 1


def test_nothing_labelled(odd):
    assert set(ratio_table(odd)) == {0.0}


def test_many_matches_and_a_long_run(spark):
    """Places by a prefix scan and the overlap test by one merge: linear in the matches and the run."""
    import random

    from newsroster.llm import secrets as S

    rng = random.Random(3)
    hexes = [''.join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(20_000)]
    run = ''.join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_000_000))
    df = spark.createDataFrame([(1, " ".join(hexes)), (2, run), (3, "x " + hexes[0] + "Z" * 30)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in S.find_secrets(df, most=10).collect()}
    spans = got[1]["spans"]
    assert len(spans) == 20_000 and [(s["start"], s["end"]) for s in spans[:2]] == [(0, 32), (33, 65)]
    assert all(s["kind"] == "hex" for s in spans)
    # a candidate that a base match touches is no added span
    assert [s["kind"] for s in got[3]["spans"]] == ["hex"]
