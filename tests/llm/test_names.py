import itertools
import random

import pytest

from talkmill.llm import names as n

SAME = [("Beatriz Tobocoza Trisimocar", x) for x in ("BEATRIZ TOBOCOZA", "B. Tobocoza Trisimocar", "Beatriz Tobcoza Trisimocar", "Tobocoza Trisimocar, Beatriz", "Bia Tobocoza Trisimocar", "Beatriz Tobocoza T.", "Trisimocar Tobocoza Beatriz", "Dra Beatriz de Tobocoza Trisimocar (trabalho)", "beatriz tobocozatrisimocar", "Beatriz Tobocoza-Trisimocar 🚗", "Baetriz Tobocoza Trisimocar")]
SAME += [("Padaria Befibrifa Vitripalol Ltda", x) for x in ("Pad. Befibrifa Vitripalol", "PADARIA BEFIBRIFA & VITRIPALOL S/A", "Befibrifa Vitripalol - Padaria")]
OTHER = [("Beatriz Tobocoza Trisimocar", x) for x in ("Caio Tobocoza Trisimocar", "Beatriz Norirote Trisimocar", "Beatriz", "C. Tobocoza Trisimocar", "Beatriz T.", "Padaria Tobocoza Trisimocar")] + [("Maria Silva Costa", "Mario Silva Costa")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    assert n.same_entity(a, b) and n.same_entity(b, a)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other(a, b):
    assert not n.same_entity(a, b)


def linked(spark, values):
    df = spark.createDataFrame([(v, 1) for v in values], "sender_name string, entity int")
    out = {}
    for r in n.entities(df).collect():
        out.setdefault(r["entity"], set()).add(r["sender_name"])
    return sorted(map(sorted, out.values()))


def test_entities(spark):
    values = ["Ana Bocapi Delomar", "ana bocapi delomar ", "Ana Bocapi Delomr", "Ana Bocapi", "Ana Bocapi", "José Bocapi Delomar", "J. Bocapi Delomar", "A. Bocapi Delomar", "Ana", "ana", None, "", "  ", "🚗", "Dr. José"]
    assert linked(spark, values) == sorted([sorted(["Ana Bocapi Delomar", "ana bocapi delomar ", "Ana Bocapi Delomr", "Ana Bocapi", "A. Bocapi Delomar"]), sorted(["José Bocapi Delomar", "J. Bocapi Delomar"])])


def test_an_initial_that_fits_two_joins_neither(spark):
    assert linked(spark, ["José Bocapi Delomar", "JOSE BOCAPI DELOMAR", "Joana Bocapi Delomar", "J. Bocapi Delomar"]) == [sorted(["José Bocapi Delomar", "JOSE BOCAPI DELOMAR"])]


def test_empty_and_long(spark):
    assert linked(spark, []) == []
    assert linked(spark, ["Ana " + "bocapi" * 4000, "x " * 5000]) == []


def test_frequent_family_names_lose_no_link(spark):
    values = [f"{g.capitalize()} Silva Costa" for g in sorted(n.GIVEN)[:12]] + ["ANA SILVA COSTA", "Ana Costa Silva", "Ana Silva"]
    groups = linked(spark, [*values, "Ana Silva Costa"])
    assert groups == [sorted({"ANA SILVA COSTA", "Ana Costa Silva", "Ana Silva", "Ana Silva Costa"})]


@pytest.mark.parametrize("pair", [("Ana Sliva", "Ana Silva"), ("Ana Sliva Costa", "Ana Silva Costa"), ("Ana B. Silva", "Ana Barbosa Silva"), ("A. Silva Costa", "Ana Silva Costa"), ("Ana Silva", "A. Silva Costa"), ("Ana Sá", "ana sa"), ("Ana Sá Silva", "Ana Sa Silva")])
def test_a_pair_is_found_whatever_else_is_frequent(spark, pair):
    others = [f"{g.capitalize()} {x}" for g in sorted(n.GIVEN) if g[0] not in "ab" for x in ("Silva", "Costa", "Barbosa")]
    assert sorted(pair) in linked(spark, [*pair, *others])


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(f"n{r.randrange(120):03d}", f"n{r.randrange(120):03d}") for _ in range(90)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {x["node"]: x["label"] for x in n.components(spark.createDataFrame(edges, "x string, y string")).collect()}
    assert got == {x: find(x) for x in list(root)}


@pytest.mark.parametrize("group", [("Ana Luz", "ANA LUZ", "Luz, Ana"), ("Ana Pó", "ana po ", "A. Pó"), ("Ana Luz", "Ana Luzz"), ("Ana Lima Po", "Ana Limapo"), ("Ana Bocapi Delomar Trocuz", "Ana Bocapidelomartrocuz"), ("Ana Bocapi Delomar", "Anabocapi Delomar"), ("Ana Leo Pó", "Analeo Pó")])
def test_short_and_run_together_tokens(spark, group):
    assert linked(spark, [*group, "José Luz", "Ana Paz"]) == [sorted(group)]


LONG = "Bocapi Delomar Trocuz Vinarel Fasipo Gutemor Hilaber"


@pytest.mark.parametrize("other", [LONG.replace("Vinarel", "Vinrael"), LONG.replace("Fasipo", "F."), LONG.replace(" Trocuz", ""), LONG.replace("r T", "rT").replace("l F", "lF")])
def test_long_names(other):
    assert n.same_entity(f"Ana {LONG}", f"Ana {other}") and n.same_entity(f"Ana {other}", f"Ana {LONG}")
    assert not n.same_entity(f"Ana {LONG}", f"Ana {other} Zuquetra".replace("Bocapi", "Wexyfo"))


def test_matching_and_run_together_against_all_orders():
    r = random.Random(5)
    words = ["ab", "ba", "abc", "a", "b", "bca", "cab", "abca", "abcab", "cabcab"]

    def assigned(fa, ia, fb, ib):
        if len(fa) + len(ia) > len(fb) + len(ib):
            fa, ia, fb, ib = fb, ib, fa, ia
        short, long = [*fa, *ia], [*fb, *ib]
        strict = len(short) < len(long) or bool(ia or ib)
        for p in itertools.permutations(long, len(short)):
            kinds = [("i" if s[0] == t[0] else "") if 1 in (len(s), len(t)) else "f" if n._cost(s, t, strict) < n.NO_FIT else "" for s, t in zip(short, p)]
            if all(kinds) and "f" in kinds:
                return True
        return False

    for _ in range(1500):
        a, b = (tuple(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(2))
        parts = [tuple(w for w in x if (len(w) == 1) == initial) for x in (a, b) for initial in (False, True)]
        assert n._assign(*parts) == assigned(*parts)
        few, many = (a, b) if len(a) < len(b) else (b, a)
        together = len(a) != len(b) and any(n.distance("".join(p), "".join(few), 2) <= 1 for p in itertools.permutations(many))
        assert n._run_together(a, b) == together, (a, b)


def test_candidates_lose_no_pair_against_brute_force(spark):
    r = random.Random(11)
    family = ["Silva", "Costa", "Antunes", "Luz", "Bocapi", "Delomar", "Sá", "Barbosa", "Po"]
    given = ["Ana", "Bruno", "Beatriz", "Bia", "Ze", "José", "A.", "B.", "Xyra", "Padaria", "Pad."]

    def typed():
        words = r.sample(family, r.randint(1, 4))
        i = r.randrange(len(words))
        w = words[i]
        kind = r.randrange(7)
        if kind == 0 and len(w) > 4:
            at = r.randrange(1, len(w) - 1)
            words[i] = w[:at] + w[at + 1] + w[at] + w[at + 2 :]
        elif kind == 1:
            words[i] = w[0] + "."
        elif kind == 2 and len(words) > 1:
            words[:2] = [words[0] + words[1].lower()]
        elif kind == 3:
            words.append(words[0])
        return f"{r.choice(given)} {' '.join(words)}"

    values = sorted({typed() for _ in range(420)})
    df = spark.createDataFrame([(v,) for v in values], "name string")
    parsed = n._parsed(df.join(n._forms(df), "name", "left_semi"))
    got = {(x["name_a"], x["name_b"]) for x in n._decided(n._candidates(n.written(parsed, "parts"))).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(values, 2) if n.same_entity(a, b)}
