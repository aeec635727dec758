from hypothesis import given
from hypothesis import strategies as st

from talkmill.llm import canonical as c
from talkmill.llm.edits import close_pairs, deletes, distance

REF = [(1, "marca", "Gazogox", None), (2, "marca", "Famafon", None), (3, "modelo", "Quacaxar", 1), (4, "modelo", "Quacaxar", 2), (5, "modelo", "Belider", 1), (6, "firma", "Sacivel Seguros", None), (7, "firma", "Grupo Malolera", None), (8, "firma", "Zacetan Seguros", None), (9, "firma", "Rotixos", None), (10, "firma", "Grupo Tedribri", None)]


def run(spark, rows, ref=REF):
    t = spark.createDataFrame(rows, "id string, marca string, modelo string, firma string").selectExpr("*", "1 AS ref_id", "2 AS value", "3 AS field", "4 AS make")
    reference = spark.createDataFrame(ref, "ref_id long, field_name string, canonical_value string, parent_ref_id long")
    out = c.canonical_values(t, reference, ("marca", "modelo", "firma"), ("id",), child="modelo", parent="marca")
    return {(r["id"], r["field_name"]): r["ref_id"] for r in out.collect()}


TYPED = [("SACIVEL", 6), ("seguros da saciv", 6), ("sacível!!", 6), ("sac-ivel", 6), ("sa civel", 6), ("scaivel seg.", 6), ("minha atual é a malolera", 7), ("Zacetna", 8), ("seguros", -1), ("grupo", -1), ("outra aí", -1), ("?", -1), ("  ", -1), ("", -1), ("Goseplevel", -1), ("rotixos " * 4000, 9)]


def test_values(spark):
    got = run(spark, [(t, None, None, t) for t, _ in TYPED])
    assert got == {(t, "firma"): ref for t, ref in TYPED}


def test_make_decides_between_equal_names(spark):
    got = run(spark, [("a", "gazogox do brasil", "quacaxar 1.6", None), ("b", "FAMAFN", "Quacaxar", None), ("c", None, "quacaxar", None), ("d", "nada disso", "quacaxr", None), ("e", "Famafon", "belider", None)])
    assert [got[x, "modelo"] for x in "abcde"] == [3, 4, 3, 3, 5] and got["d", "marca"] == -1


def test_nulls_repeats_and_empty(spark):
    assert run(spark, [(None, "Gazogox", None, None), (None, "Gazogox", None, None)]) == {(None, "marca"): 1}
    assert run(spark, []) == {}
    assert run(spark, [("a", "Gazogox", None, None)], []) == {("a", "marca"): -1}


def test_longer_entries_numbers_and_other_letters(spark):
    ref = [(1, "marca", "Onda", None), (2, "marca", "Onda Plus", None), (3, "marca", "208", None), (4, "marca", "Škoda", None), (5, "marca", "2008", None), (6, "marca", "Лада", None)]
    typed = [("Onda Plus", 2), ("onda pluss", 2), ("Onda", 1), ("minha onda", 1), ("208", 3), ("o 208 prata", 3), ("2008", 5), ("2018", -1), ("Škoda", 4), ("skoda", 4), ("SKDOA", 4), ("лада", 6), ("20 8", 3)]
    got = run(spark, [(t, t, None, None) for t, _ in typed], ref)
    assert got == {(t, "marca"): r for t, r in typed}


def test_a_reference_too_long_to_broadcast_gives_the_same(spark, monkeypatch):
    rows = [(t, None, None, t) for t, _ in TYPED[:8]]
    want = run(spark, rows)
    monkeypatch.setattr(c, "REFERENCE_ROWS", 0)
    assert run(spark, rows) == want


words = st.text("abcd", min_size=1, max_size=8)


@given(words, words)
def test_distance_and_deletions(a, b):
    from functools import lru_cache

    @lru_cache(None)
    def d(i, j):
        if i == 0 or j == 0:
            return i + j
        x = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            x = min(x, d(i - 2, j - 2) + 1)
        return x

    want = d(len(a), len(b))
    assert distance(a, b, 2) == min(want, 3)
    if want <= 2:
        assert deletes(a, 2) & deletes(b, 2)


def test_long_words_are_found_by_segments():
    import random

    from talkmill.llm.edits import LONG, index_keys, probe_keys

    r = random.Random(5)
    for n in (LONG - 1, LONG, LONG + 1, LONG + 2, 90, 3000):
        for _ in range(60):
            a = "".join(r.choice("abc") for _ in range(n))
            b = a
            for _ in range(2):
                i, kind = r.randrange(len(b) - 1), r.randrange(4)
                b = [b[:i] + b[i + 1 :], b[:i] + "x" + b[i:], b[:i] + "y" + b[i + 1 :], b[:i] + b[i + 1] + b[i] + b[i + 2 :]][kind]
            assert distance(a, b, 2) <= 2
            assert index_keys(a, 2) & probe_keys(b, 2) and index_keys(b, 2) & probe_keys(a, 2)


def test_close_pairs_against_brute_force(spark):
    import random

    from talkmill.llm.edits import allowed

    r = random.Random(2)
    ws = sorted({"".join(r.choice("abc") for _ in range(r.randint(3, 9))) for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in ws], "word string")
    got = {(x["a"], x["b"], x["d"]) for x in close_pairs(df, df).collect()}
    assert got == {(a, b, distance(a, b, 2)) for a in ws for b in ws if distance(a, b, 2) <= allowed(len(a), len(b))}
