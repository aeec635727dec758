"""Spellings of names that belong to the same person or firm.

Each distinct spelling is parsed into a head (given name or kind of firm) and family tokens; spellings with the same
parts are one form, and only one spelling of a form is compared with others. A symmetric-delete index over the distinct
tokens finds tokens at a small edit distance; forms that share close tokens are candidates, and each candidate pair is
decided by an optimal assignment of its tokens that permits initials, abbreviations, nicknames, left-out tokens and
tokens run together. Forms linked by certain pairs form an entity; a form whose head is only an initial or an ambiguous
nickname joins an entity if exactly one fits.

A pair is sought by what its assignment must hold, with the head's meaning in the key: the only family token of the
shorter side, or two tokens of it (both are among the close tokens of the longer side), or a token and an initial. So
no group of a frequent token is paired with itself, and every token is treated alike, however often it occurs.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm.edits import allowed, close_pairs, distance
from talkmill.llm.textnorm import folded
from talkmill.session import written

#: Given names of Brazil, folded.
GIVEN = frozenset(
    "adriana adriano alberto alessandra alexandre alice aline amanda ana anderson andre andrea andreia angela antonia antonio aparecida arthur augusto barbara beatriz benedito bernardo bianca bruna bruno caio camila carla carlos carolina cecilia celia celso cesar cintia clara claudia claudio conceicao cristiane cristina daniel daniela davi debora denise diego edson eduardo elaine eliane elisa elza emanuel erica fabiana fabio felipe fernanda fernando flavia flavio francisca francisco gabriel gabriela geraldo gilberto giovana graca guilherme gustavo helena helio heloisa henrique hugo ines irene isabel isabela ivone jaqueline joana joao joaquim jorge jose josefa julia juliana julio karina katia lara larissa laura leandro leonardo leticia ligia lourdes lucas lucia luciana luciano luis luisa luiz luiza manoel manuel marcela marcelo marcia marcio marcos margarida maria mariana marina mario marta mateus matheus mauricio miguel monica natalia nelson neusa olga otavio patricia paula paulo pedro plinio priscila rafael rafaela raimunda raimundo raquel regina renata renato ricardo rita roberta roberto rodrigo rogerio rosa rosana rosangela rubens samuel sandra sebastiana sebastiao sergio severina severino silvia simone solange sonia suely tatiana teresa terezinha thiago tiago valdemar valeria vanessa vera victor vinicius vitor vitoria viviane wagner wesley yasmin zelia".split()
)
#: Kinds of firms, folded.
FIRMS = frozenset("academia acougue advocacia agencia agropecuaria armazem associacao autoescola autopecas auto bar borracharia clinica colegio comercial comercio condominio confeccoes consorcio construtora consultoria cooperativa corretora distribuidora drogaria editora empresa escola estudio farmacia floricultura funilaria grafica hotel imobiliaria industria instituto laboratorio lanchonete lava livraria locadora loja madeireira mercado mercearia metalurgica moveis oficina otica padaria papelaria pizzaria posto pousada restaurante salao serralheria sorveteria supermercado tecidos transportadora transportes vidracaria".split())
#: Nicknames and the given names that they stand for.
NICKNAMES = {
    k: tuple(v.split())
    for k, v in {
        "alex": "alexandre", "babi": "barbara", "bel": "isabel isabela", "bela": "isabela", "beto": "roberto alberto gilberto", "bia": "beatriz", "bibi": "beatriz gabriela", "biu": "severino", "bru": "bruna bruno", "caca": "carlos camila", "carlinhos": "carlos", "carol": "carolina", "ceica": "conceicao", "chica": "francisca", "chico": "francisco", "cida": "aparecida", "cidinha": "aparecida", "cris": "cristina cristiane", "dani": "daniela daniel", "deia": "andrea andreia", "dema": "valdemar", "didi": "diego", "du": "eduardo", "duda": "eduardo eduarda", "dudu": "eduardo", "edu": "eduardo", "fabi": "fabiana", "fe": "fernanda fernando felipe", "felipinho": "felipe", "flavinha": "flavia", "gabi": "gabriela", "ge": "geraldo", "gege": "geraldo", "giba": "gilberto", "gil": "gilberto", "gu": "gustavo guilherme", "guga": "gustavo", "gui": "guilherme", "guida": "margarida", "guto": "augusto", "helo": "heloisa", "isa": "isabela isabel", "ivoninha": "ivone", "jo": "joana", "joaninha": "joana", "joca": "joao", "ju": "juliana julia", "juca": "jose", "juju": "juliana", "kaka": "katia carlos", "katinha": "katia", "le": "leticia leonardo", "lele": "leticia", "leo": "leonardo", "lia": "ligia", "lu": "luciana lucia luisa", "luci": "luciana", "lurdes": "lourdes", "lurdinha": "lourdes", "mandinha": "amanda", "mane": "manoel manuel", "manu": "manoel manuel", "marcinha": "marcia", "mari": "mariana", "martinha": "marta", "mila": "camila", "milena": "camila", "mundinha": "raimunda", "mundinho": "raimundo", "nanda": "fernanda", "nando": "fernando", "neco": "manoel manuel", "nelsinho": "nelson", "nel": "nelson", "neusinha": "neusa", "otavinho": "otavio", "pati": "patricia", "patty": "patricia", "pedrinho": "pedro", "quim": "joaquim", "rafa": "rafaela rafael", "raimundinha": "raimunda", "re": "renata renato", "ric": "ricardo", "rick": "ricardo henrique", "ricardinho": "ricardo", "rique": "henrique", "rodrigo": "rodrigo", "sandrinha": "sandra", "se": "sebastiao", "soninha": "sonia", "tata": "tatiana", "tati": "tatiana", "tavinho": "otavio gustavo", "tavo": "otavio gustavo", "teca": "teresa", "tete": "teresa", "tiao": "sebastiao", "ti": "tiago thiago", "toinho": "antonio", "tonho": "antonio", "toni": "antonio", "toninho": "antonio", "val": "valdemar valeria", "vivi": "vitoria viviane", "xande": "alexandre", "ze": "jose", "zeca": "jose", "zezinho": "jose",
    }.items()
}
#: What stands with a name without being part of it.
TITLES = frozenset("sr sra srta snr dr dra doutor doutora prof profa professor professora eng enga dona seu d senhor senhora pe padre pastor".split()) - {"d"}
LEGAL = frozenset("ltda me mei epp eireli sa cia companhia filhos irmaos limitada".split())
NOTES = frozenset("trabalho casa novo nova numero antigo matriz filial loja escritorio pessoal empresa whatsapp whats wpp zap celular cel fone tel contato cliente lead residencial recado".split()) - {"loja", "empresa"}
JOINERS = frozenset("de da do das dos e del di du van von y".split())
_NOTE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\b(?:novo|nova|outro) numero\b")
_LETTERS = re.compile(r"[^\W\d_]+")


@lru_cache(1 << 16)
def _known(token: str) -> tuple[str, ...]:
    """What a head token may stand for: itself, a nickname's names, a firm's kind, or the one it's misspelt from."""
    if token in GIVEN or token in FIRMS:
        return (token,)
    if token in NICKNAMES:
        return NICKNAMES[token]
    if 3 <= len(token) <= 6:
        kinds = tuple(sorted(f for f in FIRMS if f.startswith(token)))
        if kinds:
            return kinds
    if len(token) >= 3:
        near = [(distance(token, g, 2), g) for g in (*GIVEN, *FIRMS) if abs(len(g) - len(token)) <= 2 and g[0] in token[:2] + token[:1]]
        near = [(d, g) for d, g in near if d <= (1 if len(token) < 7 else 2)]
        if near:
            best = min(d for d, _ in near)
            return tuple(sorted(g for d, g in near if d == best))
    return ()


@lru_cache(1 << 16)
def parse(name: str) -> tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """(head as written, names it may stand for, family tokens, family initials); the head is '' if only one word is left."""
    text = _NOTE.sub(" ", folded(name)).replace("s/a", " ")
    parts = [p for p in text.split(",")]
    pieces = [_LETTERS.findall(p) for p in parts]
    pieces = [p for p in pieces if p]
    if len(pieces) > 1:
        pieces = [pieces[-1], *pieces[:-1]]
    words = [w for p in pieces for w in p]
    n = len(words)
    kept = []
    firm = any(w in FIRMS for w in words)
    for i, w in enumerate(words):
        if w in TITLES or (w in LEGAL and (firm or w != "sa")) or w in NOTES:  # Sá is a family name too
            continue
        if w in JOINERS and not (len(w) == 1 and (i == 0 or i == n - 1)):
            continue
        kept.append(w)
    if len(kept) < 2:
        return "", (), tuple(kept), ()
    at = None
    spots = [0, len(kept) - 1, *range(1, len(kept) - 1)]
    for test in (lambda w: w in GIVEN or w in FIRMS, lambda w: w in NICKNAMES, lambda w: len(_known(w)) > 0 and len(w) > 1):
        at = next((i for i in spots[: 2 if len(pieces) == 1 else 1] if test(kept[i])), None)
        if at is not None:
            break
    if at is None:
        at = 0 if len(kept[0]) > 1 or len(kept[-1]) > 1 or len(kept) == 2 else 0
    head = kept.pop(at)
    stands = _known(head) if len(head) > 1 else ()
    if len(head) > 1 and not stands:
        stands = (head,)
    return head, stands, tuple(w for w in kept if len(w) > 1), tuple(w for w in kept if len(w) == 1)


def uncertain(name: str) -> bool:
    """The head is an initial or may stand for several names."""
    head, stands, _, _ = parse(name)
    return len(stands) != 1


#: Costs of the assignment: an edit counts 1, an initial more than any edits, and what doesn't fit more than all else.
INITIAL_COST, NO_FIT = 3, 10**6


def _cost(s: str, t: str, strict: bool) -> int:
    if len(s) == 1 or len(t) == 1:
        return INITIAL_COST if s[0] == t[0] else NO_FIT
    d = distance(s, t, 2)
    return d if d <= min(1 if strict else 2, allowed(len(s), len(t))) else NO_FIT


def _optimal(costs: list[list[int]]) -> int:
    """Least total cost of giving each row a column of its own (no more rows than columns), by shortest augmenting paths."""
    n, m = len(costs), len(costs[0])
    u, v, owner, way = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        least, used = [float("inf")] * (m + 1), [False] * (m + 1)
        while owner[j0]:
            used[j0] = True
            i0, delta, j1 = owner[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    c = costs[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[owner[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
        while j0:
            owner[j0] = owner[way[j0]]
            j0 = way[j0]
    return -v[0]


def _assign(fa: tuple[str, ...], ia: tuple[str, ...], fb: tuple[str, ...], ib: tuple[str, ...]) -> bool:
    """True if the optimal assignment fits every token of the shorter side, at least one of them in full.

    Since an initial costs more than any edits, the optimum holds a full match wherever one is possible.
    """
    if len(fa) + len(ia) > len(fb) + len(ib):
        fa, ia, fb, ib = fb, ib, fa, ia
    short, long = [*fa, *ia], [*fb, *ib]
    strict = len(short) < len(long) or bool(ia or ib)
    costs = []
    for s in short:
        row = [_cost(s, t, strict) for t in long]
        if min(row) >= NO_FIT:
            return False
        costs.append(row)
    return _optimal(costs) < INITIAL_COST * len(short)


def _run_together(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """True if one side's tokens are the other's with neighbours run together, but for one edit."""
    if len(a) == len(b):
        return False
    few, many = (a, b) if len(a) < len(b) else (b, a)
    whole = "".join(few)
    here, there = Counter(whole), Counter("".join(many))
    if (here - there).total() > 1 or (there - here).total() > 1:
        return False
    # places reached in `whole`, tokens still to be laid there, and whether the edit is used up
    open_ = [(0, tuple(sorted(many)), False)]
    seen = set(open_)

    def lay(at: int, rest: tuple[str, ...], used: bool) -> None:
        if at <= len(whole) and (state := (at, rest, used)) not in seen:
            seen.add(state)
            open_.append(state)

    while open_:
        at, rest, used = open_.pop()
        if not rest:
            if at == len(whole) or (not used and at + 1 == len(whole)):
                return True
            continue
        for i, t in enumerate(rest):
            left = (*rest[:i], *rest[i + 1 :])
            if whole.startswith(t, at):
                lay(at + len(t), left, used)
            if used:
                continue
            for size in (len(t) - 1, len(t), len(t) + 1):
                if distance(whole[at : at + size], t, 1) == 1:
                    lay(at + size, left, True)
            for j, u in enumerate(left):  # the last letter of a token and the first of the next one swapped
                if whole.startswith(t[:-1] + u[0] + t[-1] + u[1:], at):
                    lay(at + len(t) + len(u), (*left[:j], *left[j + 1 :]), True)
    return False


def same_entity(a: str, b: str) -> bool:
    """True if two spellings may belong to one entity, taken by themselves."""
    ha, sa, fa, ia = parse(a)
    hb, sb, fb, ib = parse(b)
    if not ha or not hb:
        return False
    if sa and sb:
        if not set(sa) & set(sb):
            return _glued(ha, fa, hb, fb)
    elif sa or sb:
        initial, stands, written_ = (ha, sb, hb) if not sa else (hb, sa, ha)
        if initial != written_[0] and all(initial != s[0] for s in stands):
            return False
    elif ha != hb:
        return False
    if _assign(fa, ia, fb, ib):
        return True
    return not ia and not ib and _run_together(fa, fb)


def _glued(ha: str, fa: tuple[str, ...], hb: str, fb: tuple[str, ...]) -> bool:
    """True if a head was run together with a family token: `anasilva costa` and `ana silva costa`."""
    if len(fa) == len(fb):
        return False
    if len(fa) > len(fb):
        ha, fa, hb, fb = hb, fb, ha, fa
    joined = (ha, *fa)
    return any(_assign(joined, (), (hb + f, *fb[:i], *fb[i + 1 :]), ()) for i, f in enumerate(fb)) and any(t.startswith(hb) for t in joined)


def _roles(head: str, stands: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """Keys of a head as the first and as the second of a pair: two heads that may be the same share one, as meaning
    or, where one of them is an initial, as letter; two whole heads never meet by their letter."""
    letters = sorted({head[0], *(s[0] for s in stands)})
    if not stands:
        return [f"l:{head}", f"i:{head}"], [f"m:{head}", f"i:{head}"]
    return [*(f"s:{s}" for s in stands), *(f"m:{x}" for x in letters)], [*(f"s:{s}" for s in stands), *(f"l:{x}" for x in letters)]


def _forms(names: DataFrame) -> DataFrame:
    """name and form (all that parsing leaves of it) of each spelling that isn't a single word; equal forms are decided alike."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name in b["name"]:
                head, stands, family, initials = parse(name)
                if head and family:
                    rows.append((name, "|".join(" ".join(x) for x in ((head,), stands, family, initials)), len(stands) != 1))
            yield pd.DataFrame(rows, columns=["name", "form", "vague"])

    return names.mapInPandas(run, "name string, form string, vague boolean")


def _parsed(names: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name in b["name"]:
                head, stands, family, initials = parse(name)
                wholes = [t for t in dict.fromkeys((*family, head)) if len(t) > 2]
                glued = sorted({head + f for f in family}) if len(head) > 1 and len(family) > 1 else []
                letters = _without_one("".join(family)) if not initials else []
                others: dict[str, int] = Counter(x[0] for x in (*family, *initials))
                places = [(i, t, sorted(x for x, k in others.items() if k > (x == t[0]))) for i, t in enumerate(family)]
                # two tokens that stand for all of a name without initials: the longest ones, as they're the rarest
                two = sorted(range(len(family)), key=lambda i: (-len(family[i]), family[i], i))[:2] if len(family) > 1 and not initials else []
                rows.append((name, wholes, glued, letters, len(family), len(family) + len(initials), *_roles(head, stands), places, sorted(set(initials)), sorted(family[i] for i in two)))
            yield pd.DataFrame(rows, columns=["name", "wholes", "glued", "letters", "words", "n", "first", "second", "places", "initials", "two"])

    return names.mapInPandas(run, "name string, wholes array<string>, glued array<string>, letters array<string>, words int, n int, first array<string>, second array<string>, places array<struct<i: int, token: string, others: array<string>>>, initials array<string>, two array<string>")


def _met(left: DataFrame, right: DataFrame, where: str = "true") -> DataFrame:
    """Pairs of names with the same `head` key and `key`; the head keys are those of `_roles`. `where` may tell by n_a and n_b.

    Keys are joined by a hash: one that two keys share gives a candidate that is decided like any other.
    """
    at = F.xxhash64("head", "key").alias("at")
    a = left.select(F.col("name").alias("name_a"), F.col("n").alias("n_a"), at)
    b = right.select(F.col("name").alias("name_b"), F.col("n").alias("n_b"), at)
    return a.hint("merge").join(b, "at").where(where).select("name_a", "name_b")


def _without_one(letters: str) -> list[str]:
    """Keys of a text's letters in any order, as they are and without each one of them: two texts of which one becomes
    the other by one edit and another order share a key. Long ones are kept as digests."""
    counts = Counter(letters)
    out = []
    for skip in ("", *sorted(counts)):
        key = "".join(f"{c}{k - (c == skip)}" for c, k in sorted(counts.items()) if k > (c == skip))
        out.append(key if len(key) <= 40 else hashlib.blake2b(key.encode(), digest_size=16).hexdigest())
    return out


def _pair(a: str, b: str):
    return F.concat_ws(" ", F.least(a, b), F.greatest(a, b)).alias("key")


def _candidates(parsed: DataFrame) -> DataFrame:
    words = parsed.select(F.explode("places.token").alias("word"))
    close = written(close_pairs(words, words).select("a", "b"), "close-tokens")
    heads = lambda df, role: df.withColumn("head", F.explode(role))
    single = heads(parsed.where("n = 1"), "first").select("name", "n", "head", F.col("places")[0]["token"].alias("key"))
    two = heads(parsed.where("size(two) = 2"), "first").select("name", "n", "head", "two")
    own = heads(parsed.where("size(initials) > 0"), "first").select("name", "n", "head", "initials", F.explode(F.array_distinct("places.token")).alias("t"))
    # what the other side may be asked for: a head with a token. Most of the tokens that are close by chance aren't
    asked = single.select("head", F.col("key").alias("t")).unionByName(two.select("head", F.explode("two").alias("t"))).unionByName(own.select("head", "t"))
    asked = asked.select(F.xxhash64("head", "t").alias("at")).distinct()
    placed = parsed.select("name", "n", "second", F.explode("places").alias("p")).select("name", "n", "second", "p.*")
    near = placed.join(close.toDF("token", "near").hint("merge"), "token").select("name", "n", "i", "others", "near", F.explode("second").alias("head"))
    near = written(near.withColumn("at", F.xxhash64("head", "near")).join(asked.hint("merge"), "at", "left_semi").drop("at"), "name-near")
    # the shorter side's only token
    short = _met(single, near.select("name", "n", "head", F.col("near").alias("key")))
    # two tokens of the shorter side; the pairs of the longer one are laid out row by row
    sided = near.groupBy("name", "n", "head").agg(F.collect_set(F.struct("i", "near")).alias("o"))
    left = sided.select("name", "n", "head", "o", F.explode("o").alias("x")).select("name", "n", "head", "x", F.explode(F.expr("filter(o, y -> y.i > x.i)")).alias("y"))
    twice = _met(two.select("name", "n", "head", F.concat_ws(" ", F.col("two")[0], F.col("two")[1]).alias("key")), left.select("name", "n", "head", _pair("x.near", "y.near")), "n_a <= n_b")
    # an initial of one side that stands for a token or initial of the other, beside a token of both
    letter = F.concat_ws(" ", "x", "t").alias("key")
    other = near.select("name", "n", "head", F.explode("others").alias("x"), F.col("near").alias("t"))
    with_initial = _met(own.select("name", "n", "head", F.explode("initials").alias("x"), "t").select("name", "n", "head", letter), other.select("name", "n", "head", letter))
    # a head run together with a family token
    whole = parsed.select(F.col("name").alias("name_a"), F.explode("wholes").alias("a"))
    parts = parsed.select(F.col("name").alias("name_b"), F.explode("glued").alias("b"))
    glued = close_pairs(whole.select(F.col("a").alias("word")), parts.select(F.col("b").alias("word")), depth=1).select("a", "b")
    together = whole.join(glued.hint("merge"), "a").join(parts.hint("merge"), "b").select("name_a", "name_b")
    # family tokens run together, by the letters of all of them
    spelt = parsed.select("name", "n", "first", "second", F.explode("letters").alias("key"))
    together = together.unionByName(_met(heads(spelt, "first"), heads(spelt.where("n > 1"), "second"), "n_a < n_b"))
    every = short.unionByName(twice).unionByName(with_initial).unionByName(together).where("name_a <> name_b")
    return every.select(F.least("name_a", "name_b").alias("name_a"), F.greatest("name_a", "name_b").alias("name_b")).distinct()


def _decided(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[[same_entity(x, y) for x, y in zip(b["name_a"], b["name_b"])]].copy()
            b["vague_a"] = [uncertain(x) for x in b["name_a"]]
            b["vague_b"] = [uncertain(x) for x in b["name_b"]]
            yield b

    return pairs.mapInPandas(run, "name_a string, name_b string, vague_a boolean, vague_b boolean")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and label (the least node of its component) of every node in `edges` (columns x, y).

    Labels move along edges and are then shortened; each round is a written table, and the rounds end when nothing
    changes. Raises if `rounds` aren't enough.
    """
    both = written(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).withColumnRenamed("x", "node")
    labels = written(labels, "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        moved = labels.join(near.withColumnRenamed("x", "node"), "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("before"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = written(moved.join(jump, "next").select("node", F.least("next", "far").alias("label"), "before"), "labels")
        changed = new.where("label <> before").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components weren't settled after {rounds} rounds")


def entities(rows: DataFrame, name: str = "sender_name") -> DataFrame:
    """name and entity (the least spelling of the entity) for each distinct spelling that is linked to another one.

    Null and blank names, and names of a single word (titles, notes and legal forms not counted), are linked to
    nothing. Spellings of one form that may stand for several entities aren't linked. Repeated rows count once; spellings that differ only in case or white space are different spellings of
    one entity. Extra columns are ignored. An empty table gives an empty result.
    """
    names = rows.select(F.col(name).cast("string").alias("name")).where("name IS NOT NULL").distinct()
    members = written(_forms(names), "names")
    forms = written(members.groupBy("form").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("members"), F.first("vague").alias("vague")), "name-forms")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    parsed = written(_parsed(forms.select("name").repartition(tasks)), "name-parts")
    edges = written(_decided(_candidates(parsed)), "name-edges")
    sure = edges.where("NOT vague_a AND NOT vague_b").select(F.col("name_a").alias("x"), F.col("name_b").alias("y"))
    label = components(sure)
    mixed = edges.where("vague_a <> vague_b").select(F.when(F.col("vague_a"), F.col("name_a")).otherwise(F.col("name_b")).alias("vague"), F.when(F.col("vague_a"), F.col("name_b")).otherwise(F.col("name_a")).alias("node"))
    targets = mixed.join(label, "node", "left").select("vague", F.coalesce("label", "node").alias("label")).distinct()
    targets = written(targets.groupBy("vague").agg(F.count(F.lit(1)).alias("k"), F.min("label").alias("label")), "vague-names")
    loose = edges.where("vague_a AND vague_b").select(F.col("name_a").alias("x"), F.col("name_b").alias("y"))
    taken = targets.select(F.col("vague").alias("t"))
    alone = loose.join(taken, loose["x"] == taken["t"], "left_anti").join(taken.withColumnRenamed("t", "u"), F.expr("y = u"), "left_anti")
    joined = targets.where("k = 1").select(F.col("vague").alias("node"), "label")
    roots = joined.select(F.col("label").alias("node"), "label").distinct()
    found = label.unionByName(joined).unionByName(roots).unionByName(components(alone)).distinct()
    torn = targets.where("k > 1").select(F.col("vague").alias("node"))  # may be of several entities: linked to none
    several = forms.where("members > 1").select(F.col("name").alias("node")).join(found, "node", "left_anti").join(torn, "node", "left_anti").select("node", F.col("node").alias("label"))
    labels = found.unionByName(several).withColumnRenamed("node", "first")
    spelt = members.select("name", "form").join(forms.select("form", F.col("name").alias("first")), "form").join(labels, "first").select("name", "label")
    # the least spelling of an entity is the least of its forms' least ones, or joined to it later
    least = spelt.groupBy("label").agg(F.min("name").alias("entity"))
    return spelt.join(least, "label").select(F.col("name").alias(name), "entity")


def p6_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(spark.read.parquet(f"{sf_dir}/bronze.parquet"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = written(p6_entities(spark, sf_dir), "name-entities")
    a, b = e.select(F.col("sender_name").alias("name_a"), "entity"), e.select(F.col("sender_name").alias("name_b"), "entity")
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
