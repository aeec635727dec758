"""Personal information in free text, tagged by a linear-chain conditional random field and replaced.

The field runs over tokens (words, whole number groups, addresses of mail, marks and line ends). Its features are
a token's shape and a few closed word classes, at the token and up to two tokens around it. It is trained on the
driver from the labelled table of `pii_table` (TABLE_ROWS rows, a parameter). Since features are additive, each
distinct token has fixed score vectors, which a task computes once; decoding is Viterbi over numpy batches of
equal padded length. Rows never leave their partition; repeated texts of a batch are decoded once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm.names import GIVEN, NICKNAMES, TITLES
from talkmill.llm.pii_table import RANKS, STREETS, labelled_rows
from talkmill.llm.textnorm import folded

KINDS = ("email", "phone", "id_number", "address", "name")
LABELS = ["O", *[f"{x}-{k}" for k in KINDS for x in "BI"]]
#: Rows of the labelled table used for training.
TABLE_ROWS = 14_000
EPOCHS = 7
REACH = 2
_LOCAL, _HOST = r"[\w.+\-]+", r"[A-Za-z0-9][\w\-]*"
_AT = r"(?:\s?@\s?|\s?[\[(](?:at|arroba)[\])]\s?|\s(?:arroba|at)\s)"
_DOT = r"(?:\.|\s\.\s|\s?[\[(](?:dot|ponto)[\])]\s?|\s(?:ponto|dot)\s)"
TOKEN = re.compile(
    rf"(?P<e>{_LOCAL}{_AT}{_HOST}(?:{_DOT}{_HOST})+)"
    r"|(?P<n>(?:\b[A-Za-z]{2}-(?=\d))?(?:\b0[xX]{2}(?=\d)|\+?\(?(?=\d))\d(?:(?:[ .\-/]|\)[ ]?-?|[ ]?\()?(?:\d|(?<=[\d.\-OoIl])[OoIl](?=[\d.\-OoIl ]|\b)))*(?:-?[xX]\b)?)"
    r"|(?P<s>\b[sS]/[nN]\b)|(?P<w>[^\W\d_]+)|(?P<l>\n+)|(?P<p>[^\w\s]|_)",
    re.I,
)
_AS_DIGIT = re.compile(r"(?<=[\d.\-OoIl])[OoIl](?=[\d.\-OoIl ]|\b)")
_STREET = frozenset(folded(s).strip(".") for s in STREETS)
_RANK = frozenset(folded(s).strip(".") for s in RANKS)
_UNIT = frozenset("apto ap apartamento casa bloco bl fundos sala loja cj conjunto sobrado terreo torre lote quadra".split())
_NUMBER = frozenset("n no numero num nº n° s sn".split())
_NICK = frozenset(k for k in NICKNAMES if len(k) > 2 or k in ("ze", "ju", "lu", "ge"))


def tokens(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.lastgroup) for m in TOKEN.finditer(text)]


def signature(text: str, kind: str) -> str:
    """What the features see of a token: digits are reduced to their pattern."""
    if kind == "n":
        text = _AS_DIGIT.sub("0", text)
        d = re.sub(r"\D", "", text)
        mobile = (len(d) == 11 and d[2] == "9") or (len(d) == 13 and d.startswith("55") and d[4] == "9") or (len(d) == 12 and d[0] == "0" and d[3] == "9") or (len(d) == 9 and d[0] == "9")
        return f"n{re.sub(r'[0-9]', 'd', text.lower())}|{len(d)}|{int(mobile)}{int(len(d) in (12, 13) and d.startswith('55'))}{int(d.startswith('20'))}{int(d.startswith('0'))}"
    if kind == "e":
        at = text.find("@")
        return "e" + ("w" if at < 0 else "nlrb"[text[at - 1 : at].isspace() + 2 * text[at + 1 : at + 2].isspace()])
    return kind + ("" if kind in "ls" else text)


@lru_cache(1 << 17)
def features(sig: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Features of a token at its own place, and the fewer ones that its neighbours see."""
    kind, body = sig[0], sig[1:]
    if kind == "n":
        pattern, n, flags = body.rsplit("|", 2)
        return (f"n:{pattern}", f"n#{n}", f"nf{flags}", f"n#{n}{flags}", "n", "b"), (f"n#{n}", "n", f"n:{pattern}" if len(pattern) < 6 else "nlong")
    if kind == "w":
        low = folded(body)
        shape = "X" if len(body) == 1 and body.isupper() else "Xx" if body[0].isupper() and body[1:].islower() else "XX" if body.isupper() else "xx" if body.islower() else "xX"
        out = [f"w={low}", f"s={shape}", f"l={min(len(low), 8)}", f"e={low[-2:]}", f"e={low[-3:]}", f"{shape}{min(len(low), 4)}", "w", "b"]
        near = [f"w={low}", f"s={shape}"]
        for name, group in (("given", GIVEN), ("nick", _NICK), ("street", _STREET), ("rank", _RANK), ("unit", _UNIT), ("title", TITLES), ("number", _NUMBER)):
            if low in group:
                out += [name, f"{name}{shape}"]
                near.append(name)
        return tuple(out), tuple(near)
    if kind == "e":
        return (f"e{body}", "e", "b"), ("e",)
    return (f"{kind}{body}", "b"), (f"{kind}{body}",)


class Crf:
    """Weights of a linear-chain field: per feature and offset a row of label scores, and label transitions."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, transitions: np.ndarray):
        self.index, self.weights, self.transitions = index, weights, transitions
        self.number: dict[str, int] = {}
        self.scores = np.zeros((0, 2 * REACH + 1, len(LABELS)), np.float32)

    def __getstate__(self):
        return self.index, self.weights, self.transitions

    def __setstate__(self, state):
        self.__init__(*state)

    def ids(self, sig: str, offset: int) -> list[int]:
        own, near = features(sig)
        return [i for f in (near if offset else own) if (i := self.index.get(f"{offset}{f}")) is not None]

    def learn(self, sigs: set[str]) -> None:
        new = [s for s in sigs if s not in self.number]
        if not new:
            return
        if len(self.number) > 300_000:
            self.number, self.scores = {}, self.scores[:0]
            new = list(sigs)
        rows = np.zeros((len(new), 2 * REACH + 1, len(LABELS)), np.float32)
        for r, s in enumerate(new):
            self.number[s] = len(self.scores) + r
            for o in range(-REACH, REACH + 1):
                if at := self.ids(s, o):
                    rows[r, o + REACH] = self.weights[at].sum(0)
        self.scores = np.concatenate([self.scores, rows])

    def emissions(self, numbers: np.ndarray) -> np.ndarray:
        """Scores (text, place, label) for padded token numbers (-1 where there's no token)."""
        b, t = numbers.shape
        out = np.zeros((b, t, len(LABELS)), np.float32)
        real = numbers >= 0
        for o in range(-REACH, REACH + 1):
            # a token at place j is seen by place i = j - o
            i0, i1 = max(0, -o), t - max(0, o)
            if i1 <= i0:
                continue
            near = numbers[:, i0 + o : i1 + o]
            part = self.scores[np.maximum(near, 0), o + REACH]
            part[near < 0] = 0
            out[:, i0:i1] += part
        out[~real] = 0
        return out

    def decode(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each text's token signatures."""
        self.learn({s for t in texts for s in t})
        best: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        a = 0
        while a < len(order):
            longest, b = lengths[order[a]], a
            while b < len(order) and (lengths[order[b]] <= max(longest * 1.25, longest + 3)) and (b - a) * lengths[order[b]] < 60_000:
                b += 1
            b = max(b, a + 1)
            chosen = order[a:b]
            width = int(lengths[chosen].max())
            grid = np.full((len(chosen), width), -1, np.int64)
            for r, i in enumerate(chosen):
                grid[r, : lengths[i]] = [self.number[s] for s in texts[i]]
            for r, path in enumerate(self._viterbi(self.emissions(grid), lengths[chosen])):
                best[chosen[r]] = path
            a = b
        return best

    def _viterbi(self, e: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        n, t, k = e.shape
        back = np.zeros((n, t, k), np.int8)
        score = e[:, 0] + START
        final = score.copy()
        trans = self.transitions + FORBIDDEN
        for i in range(1, t):
            step = score[:, :, None] + trans
            back[:, i] = step.argmax(1)
            score = step.max(1) + e[:, i]
            live = lengths > i
            final[live] = score[live]
        last = final.argmax(1)
        paths = np.zeros((n, t), np.int64)
        rows = np.arange(n)
        for i in range(t - 1, -1, -1):
            at_end = lengths - 1 == i
            inside = lengths - 1 > i
            paths[at_end, i] = last[at_end]
            if i + 1 < t:
                paths[inside, i] = back[rows[inside], i + 1, paths[inside, i + 1]]
        return [paths[r, : lengths[r]] for r in range(n)]


_K = len(LABELS)
FORBIDDEN = np.zeros((_K, _K), np.float32)
START = np.zeros(_K, np.float32)
for _j, _to in enumerate(LABELS):
    if _to[0] == "I":
        START[_j] = -1e6
        for _i, _from in enumerate(LABELS):
            if _from[1:] != _to[1:]:
                FORBIDDEN[_i, _j] = -1e6


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


def _add_rows(to: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Adds each row of `values` to row `at` of `to`; `at` is sorted."""
    if len(at):
        starts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        to[at[starts]] += np.add.reduceat(values, starts, axis=0)


def train(rows: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = EPOCHS, rate: float = 0.05, decay: float = 1e-5, seed: int = 3) -> Crf:
    """Maximum likelihood by mini-batches with Adam; features seen fewer than three times are dropped."""
    sequences = []
    for text, items in rows:
        toks = tokens(text)
        labels, last = [], -1
        for s, e, _ in toks:
            start, kind = next(((a, k) for a, b, k in items if s >= a and e <= b), (-1, ""))
            labels.append(LABELS.index(("I-" if start == last else "B-") + kind) if kind else 0)
            last = start
        if toks:
            sequences.append(([signature(text[s:e], k) for s, e, k in toks], labels))
    counts: dict[str, int] = {}
    for sigs, _ in sequences:
        for s in sigs:
            own, near = features(s)
            for o in range(-REACH, REACH + 1):
                for f in near if o else own:
                    counts[f"{o}{f}"] = counts.get(f"{o}{f}", 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, c in counts.items() if c > 2))}
    model = Crf(index, np.zeros((len(index), _K), np.float32), np.zeros((_K, _K), np.float32))
    encoded = []
    for sigs, labels in sequences:
        owner, ids = [], []
        for i in range(len(sigs)):
            for o in range(-REACH, REACH + 1):
                if 0 <= i + o < len(sigs):
                    found = model.ids(sigs[i + o], o)
                    owner += [i] * len(found)
                    ids += found
        encoded.append((np.array(owner), np.array(ids), np.array(labels)))
    random = np.random.default_rng(seed)
    w, m, v = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    tr, tm, tv = model.transitions, np.zeros((_K, _K), np.float32), np.zeros((_K, _K), np.float32)
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(encoded))
        for a in range(0, len(order), 64):
            chosen = [encoded[i] for i in order[a : a + 64]]
            n, t = len(chosen), max(len(x[2]) for x in chosen)
            length = np.array([len(x[2]) for x in chosen])
            cell = np.concatenate([r * t + x[0] for r, x in enumerate(chosen)])
            feat = np.concatenate([x[1] for x in chosen])
            gold = np.zeros((n, t), np.int64)
            for r, x in enumerate(chosen):
                gold[r, : len(x[2])] = x[2]
            e = np.zeros((n * t, _K), np.float32)
            _add_rows(e, cell, w[feat])
            e = e.reshape(n, t, _K)
            trans = tr + FORBIDDEN
            alpha = np.zeros((n, t, _K), np.float32)
            beta = np.zeros((n, t, _K), np.float32)
            alpha[:, 0] = e[:, 0] + START
            for i in range(1, t):
                alpha[:, i] = _logsum(alpha[:, i - 1, :, None] + trans, 1) + e[:, i]
            for i in range(t - 2, -1, -1):
                live = (length > i + 1)[:, None]
                beta[:, i] = np.where(live, _logsum(trans + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2), 0)
            z = _logsum(alpha[np.arange(n), length - 1], 1)
            mask = np.arange(t)[None] < length[:, None]
            p = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
            p[np.arange(n)[:, None], np.arange(t)[None], gold] -= mask
            g = np.zeros_like(w)
            order_ = np.argsort(feat, kind="stable")
            _add_rows(g, feat[order_], p.reshape(n * t, _K)[cell[order_]])
            gt = np.zeros_like(tr)
            for i in range(1, t):
                live = length > i
                if live.any():
                    pair = np.exp(alpha[live, i - 1, :, None] + trans + (e[live, i] + beta[live, i])[:, None, :] - z[live, None, None])
                    gt += pair.sum(0)
                    np.subtract.at(gt, (gold[live, i - 1], gold[live, i]), 1)
            step += 1
            for x, gx, mx, vx in ((w, g / n + decay * w, m, v), (tr, gt / n, tm, tv)):
                mx *= 0.9
                mx += 0.1 * gx
                vx *= 0.999
                vx += 0.001 * gx * gx
                x -= rate * (mx / (1 - 0.9**step)) / (np.sqrt(vx / (1 - 0.999**step)) + 1e-6)
    return model


@lru_cache(2)
def model(rows: int = TABLE_ROWS, held: bool | None = None) -> Crf:
    """The field trained from `rows` rows of the labelled table; the same every time."""
    return train(labelled_rows(rows, held=held))


def accuracy(crf: Crf, rows: list[tuple[str, list[tuple[int, int, str]]]]) -> tuple[float, float]:
    """(precision, recall) over the exact items of labelled rows."""
    right = wrong = missed = 0
    for (_, items), got in zip(rows, find_items(crf, [t for t, _ in rows])):
        right += len(set(items) & set(got))
        wrong += len(set(got) - set(items))
        missed += len(set(items) - set(got))
    return right / (right + wrong), right / (right + missed)


_LONG_NUMBER = re.compile(r"(?:\d\D{0,3}){8}")
_END = re.compile(r"[\s.,;:!?\-–(]+$")
#: An address is a street's name and, apart from it, a number.
_HAS_NUMBER = re.compile(r"\d|\bs/?n\b", re.I)


def _checked(text: str, a: int, b: int, kind: str) -> tuple[int, int] | None:
    """The item's exact borders, or None if it can't be of its kind."""
    item = text[a:b]
    digits = sum(c.isdigit() for c in item)
    if kind == "phone":
        return (a, b) if digits else None
    if kind == "id_number":
        return (a, b) if digits else None
    if kind == "email":
        return (a, b)
    if kind == "address":
        b = a + len(_END.sub("", item))
        return (a, b) if _HAS_NUMBER.search(text[a:b]) and " " in text[a:b] else None
    if not re.search(r"\s[A-ZÀ-Ý]\.$", item):
        b = a + len(_END.sub("", item))
    return (a, b) if b > a and any(c.isalpha() for c in text[a:b]) else None


def find_items(crf: Crf, texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """Items (start, end, kind) of each text, in order and apart from each other."""
    toks = [tokens(t) for t in texts]
    labels = crf.decode([[signature(t[s:e], k) for s, e, k in ts] for t, ts in zip(texts, toks)])
    out = []
    for text, ts, path in zip(texts, toks, labels):
        spans: list[list] = []
        for (s, e, _), y in zip(ts, path):
            label = LABELS[y]
            if label[0] == "B":
                spans.append([s, e, label[2:]])
            elif label[0] == "I":
                spans[-1][1] = e
        out.append([(*c, k) for s, e, k in spans if (c := _checked(text, s, e, k))])
    return out


def _own(phone) -> str:
    """The last eight digits of a row's own phone, which every way of writing it has; '' if there are fewer."""
    d = re.sub(r"\D", "", phone) if isinstance(phone, str) else ""
    return d[-8:] if len(d) >= 8 else ""


def _with_own(text: str, items: list[tuple[int, int, str]], own: str) -> list[tuple[int, int, str]]:
    """`items`, and the row's own phone wherever it's written outside of them."""
    if not own:
        return items
    more = []
    for s, e, k in tokens(text):
        if k == "n" and re.sub(r"\D", "", _AS_DIGIT.sub("0", text[s:e])).endswith(own) and not any(a < e and s < b for a, b, _ in items):
            more.append((s, e, "phone"))
    return sorted([*items, *more]) if more else items


def _tag(texts: DataFrame, text: str, own: str | None, rows: int, render, schema: str) -> DataFrame:
    crf = texts.sparkSession.sparkContext.broadcast(model(rows))  # a few MB: bounded by the labelled table

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = crf.value
        for b in batches:
            code, unique = pd.factorize(b[text])
            unique = list(unique)
            items = find_items(field, unique)
            if own is None:
                each = [items[c] if c >= 0 else [] for c in code]
            else:
                loose = {c for c, t in enumerate(unique) if _LONG_NUMBER.search(t)}
                each = [[] if c < 0 else _with_own(unique[c], items[c], _own(p)) if c in loose else items[c] for c, p in zip(code, b[own])]
            yield render(b, each)

    return texts.mapInPandas(run, schema)


def personal_items(messages: DataFrame, keys: tuple[str, ...] = ("conversation_id", "message_id"), text: str = "message_body", phone: str | None = "sender_phone", rows: int = TABLE_ROWS) -> DataFrame:
    """keys, pii_kind, pii_text: one row per different item of each identified message.

    `phone` is the row's own phone: where the text holds it in whatever form, it's an item even if the field didn't tag
    it (no such column: no such check). Rows with a null key take no part; null, empty and blank texts have no items;
    texts of any length are read whole. Repeated rows, and an item that occurs twice in a message, give one row. Extra
    columns are ignored. An empty table gives an empty result.
    """
    names = [f"k{i}" for i in range(len(keys))]
    has = phone is not None and phone in messages.columns

    def render(b: pd.DataFrame, each: list) -> pd.DataFrame:
        at = np.repeat(np.arange(len(b)), [len(x) for x in each])
        texts = b["text"].to_numpy()
        out = b[names].iloc[at].reset_index(drop=True)
        out["pii_kind"] = pd.Series([k for x in each for _, _, k in x], dtype="object")
        out["pii_text"] = pd.Series([texts[i][s:e] for i, x in enumerate(each) for s, e, _ in x], dtype="object")
        return out

    own = F.col(phone).cast("string") if has else F.lit(None).cast("string")
    rows_in = messages.select(*[F.col(k).cast("string").alias(n) for k, n in zip(keys, names)], F.col(text).cast("string").alias("text"), own.alias("own")).where(" AND ".join([f"{n} IS NOT NULL" for n in names] + ["text IS NOT NULL"]))
    tagged = _tag(rows_in, "text", "own" if has else None, rows, render, ", ".join([f"{n} string" for n in names] + ["pii_kind string", "pii_text string"]))
    return tagged.distinct().toDF(*keys, "pii_kind", "pii_text")


def redact(messages: DataFrame, text: str = "message_body", phone: str | None = "sender_phone", rows: int = TABLE_ROWS, placeholder: str = "[{}]") -> DataFrame:
    """`messages` with each item of `text` replaced by a placeholder of its kind, `[EMAIL]` and so on; all else unchanged.

    Null stays null, and the text around items keeps every character. All other columns, whatever their names, are
    passed through; one row out per row in. `phone` as in `personal_items`.
    """
    schema = messages.schema
    at = schema.fieldNames().index(text)
    has = phone is not None and phone in messages.columns
    own = f"c{schema.fieldNames().index(phone)}" if has else None
    inner = messages.toDF(*[f"c{i}" for i in range(len(schema))])

    def render(b: pd.DataFrame, each: list) -> pd.DataFrame:
        done = []
        for t, found in zip(b[f"c{at}"], each):
            for s, e, k in reversed(found):
                t = t[:s] + placeholder.format(k.upper()) + t[e:]
            done.append(t)
        b[f"c{at}"] = done
        return b

    return _tag(inner, f"c{at}", own, rows, render, inner.schema).toDF(*schema.fieldNames())


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_items(spark.read.parquet(f"{sf_dir}/bronze.parquet"))


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = spark.read.parquet(f"{sf_dir}/bronze.parquet").where("conversation_id IS NOT NULL AND message_id IS NOT NULL")
    return redact(bronze.select("conversation_id", "message_id", "message_body", "sender_phone")).drop("sender_phone").distinct()
