"""Records that hold template residue, filler, error pages or demands for scripts instead of content.

A text is cut into units (lines and sentences). Placeholder detectors look for unfilled slots anywhere. Each unit is
judged by its terms: a response (error, script demand, filler), furniture of a page, told by a person, or open. What is
open is settled by evidence that is combined over all documents, whatever the unit's length:

* vocabulary: words that recur in different units, hardly ever with a function word of a language and always among the
  same few others, are words of a placeholder text; a unit that consists of them is filler, in whatever made-up Latin.
* host: a unit belongs to responses if most documents of its source that hold it have a response and no content.
* terms: each word counts by how much more often it stands in units of responses than in units of other documents
  (log odds over distinct units, so copies count once; a unit doesn't vouch for itself).
* duplicates: an open unit that several documents of a source repeat, many of them responses, and whose terms agree,
  is a learned response.

A document is a case if it has a slot, or at least one response (listed, filler or learned) and no content.
The documents have no address and no title: the source stands for the host, and nothing stands for slug and title.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm.textnorm import folded, plain
from talkmill.session import written

#: Words that name a field of a letter, contract or form.
FIELDS = "nome name first last full customer client cliente titular holder user usuario email mail telefone phone fone celular endereco address rua cidade city ciudad uf estado state cep zip placa plate marca make modelo model veiculo vehicle vehiculo ano year franquia deductible franquicia premio premium prima parcela parcelas installments cuotas valor total amount price preco precio data date fecha dia vigencia validade numero number apolice policy poliza corretor corretora broker empresa company produto product assunto subject mensagem message titulo title texto text conteudo content assinatura signature cargo cpf cnpj rg id codigo code link url vencimento seguradora insurer cobertura".split()
#: Words that ask somebody to fill something in.
FILL = r"preencher|preencha|completar|inserir|insira|insert|incluir|substituir|trocar|digite|digitar|informar|colocar|coloque|rellenar|enter|fill|your|aqui|here|aca|revisar|a definir|tbd|todo|pendente|confirmar"
_NAME = r"[#/&^!=\-]?[ ]?[a-z_][\w.\- ]*"
_FIELD = rf"(?:{'|'.join(sorted(FIELDS, key=len, reverse=True))})"
_KNOWN = rf" ?{_FIELD}(?:[ _.\-]?(?:{_FIELD}|d[aeo]s?|no|na|the|of))*[ _]?\d?"
#: Slots in folded text, each after a string that the text must hold for it. The first ones are told by their
#: delimiters alone; {x}, <x>, [x] and the like occur in ordinary text too, so there the name must be a known
#: field or an instruction; then come blanks to be written over and what programs print for a missing value.
SLOTS = [
    ("{{", rf"\{{\{{\{{?{_NAME}\}}\}}"), ("{%", r"\{%-? ?[a-z][^{}%]*%\}"), ("<%", r"<%[=\-]? ?[a-z][^<>%]*%>"), ("{", rf"[$@]\{{{_NAME}\}}"), ("%%", rf"%%{_NAME}%%"),
    ("@@", rf"@@{_NAME}@@"), ("*|", rf"\*\|{_NAME}\|\*"), ("[[", rf"\[\[{_NAME}\]\]"), ("<<", rf"<<{_NAME}>>"), ("__", r"__[a-z][a-z0-9. ]*(?:_[a-z0-9. ]+)*__"),
    ("{", rf"\{{{_KNOWN}\}}"), ("<", rf"<{_KNOWN}>"), ("[", rf"\[{_KNOWN}\]"), ("«", rf"«{_NAME}»"), ("%", rf"%{_KNOWN}%"), ("$", rf"\${_KNOWN}\$"), ("#", rf"#{_KNOWN}#"), ("(", rf"\({_KNOWN}\)(?=\s*(?:$|[!|]))"),
    *[(a, rf"\{a}(?:[^\[\](){{}}<>\n]*[ :])?(?:{FILL})(?:[ :][^\[\](){{}}<>\n]*)?\{b}") for a, b in ("[]", "()", "{}", "<>")],
    ("[", r"\[[●•_.\-? ]{1,20}\]"), ("[", r"\[object object\]"), ("____", r"_{4,}"), ("__/", r"__/__/__"), (".....", r"(?<![.\w])\.{5,}(?!\w)"), ("xx", r"(?<!\w)x{2,}(?:[/.\-,]x{2,})+(?!\w)"), ("$ x", r"\$ ?x{2,}\b"),
    ("%", r"(?<![\w%])%(?:s|d|\d+\$s|\([a-z_]+\)s)(?!\w)"), ("{", r"(?<![\w\"{])\{\d{0,2}\}(?!\w)"),
    *[(w, rf"(?:ola|prezad[oa](?:\([ao]\))?|car[oa]|dear|hello|hi|estimad[oa](?:\([ao]\))?|hola|sr\.?a?|atenciosamente,?|regards,?|saludos,?|com|with|con|de|em|on|el|titular:) {w}(?![a-z])") for w in ("undefined", "null", "nan", "none", "n/a", "nil")],
]
SLOTS = [(a, re.compile(p)) for a, p in SLOTS]

#: Terms of messages by machines, folded. Each is evidence that a unit is a response.
ERROR = re.compile(
    r"\b(?:http|error|erro|codigo|code|status)[ :\-]{0,3}[45]\d\d\b|\b[45]\d\d (?:bad|not|internal|service|gateway|forbidden|unauthorized|too)|bad gateway|gateway time|pagina nao encontrada|page (?:was )?not found|not found|no encontrad[oa]|nao (?:foi )?encontrad[oa]"
    r"|nao foi possivel|no fue posible|could ?n.t be|can.t be reached|unavailable|indisponivel|no esta disponible|fora do ar|tempo limite|timed? ?out|respondeu a tempo|conexao|connection|falha interna|internal (?:failure|error|server)|falhou ao|erro inesperado|unexpected error|algo deu errado|something went wrong"
    r"|acesso negado|access denied|forbidden|nao tem permissao|sessao expirou|session (?:has )?expired|entre novamente|log ?in again|em manutencao|maintenance|voltamos em breve|muitas requisicoes|too many requests|limite de acessos|rate limit|aguarde e recarregue|recarregue|reload|nao (?:e|sao) um robo|not a robot|captcha"
    r"|traceback|exception|stack ?trace|\bat [\w.]+\([\w.]+:\d+\)|\bem calcular\b|valorinvalido|banco de dados|database|mudou de lugar|nao existe mais|nao estao? disponive(?:l|is)|foi removid[oa]|has (?:been )?moved|no longer exists|tente (?:novamente|de novo|mais tarde)|try again|intente|verifique as configuracoes|nao serao exibidas|internal"
)
SCRIPT = re.compile(r"\bjava ?scripts?\b|\bjs\b|\bscripts?\b|bloqueador|ad ?block|navegador|browser|cookies")
FILLER = re.compile(
    r"lorem|ipsum|dolor sit|consectetur|\b(?:asdf|qwer|zxcv|hjkl|foo|bar|baz|blah?)\b|\b(x{3,}|a{4,}|b{4,}|c{4,})\b|texto (?:de|para) (?:exemplo|relleno|preench\w*|teste)|sample text|placeholder|dummy|texto texto|conteudo (?:provisorio|de teste)|paragrafo de teste|\btest(?:e|es|ing|ando)? test(?:e|es|ing|ando)?\b|\d+ testando"
    r"|(?:sub)?titulo aqui|(?:coloque|insira|escreva|digite)\b.{0,20}(?:aqui|conteudo|texto|descricao)|\ba definir\b|\btbd\b|em construcao|under construction|rascunho vazio|substituir este|todo:? redigir|your text here"
)
#: Words of the placeholder Latin that its further sentences are made of. Those of the second set are
#: words of other languages too: they count, but don't tell filler by themselves.
LATIN = frozenset("lorem ipsum amet consectetur consectetuer adipiscing elit eiusmod tempor incididunt ut labore et dolore aliqua enim veniam nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt deserunt mollit anim laborum vestibulum pellentesque curabitur suspendisse vivamus maecenas praesent phasellus aliquam faucibus tincidunt sagittis ultrices ultricies scelerisque sollicitudin ullamcorper vulputate dapibus tristique lobortis malesuada bibendum condimentum fermentum hendrerit imperdiet interdum lacinia mauris nullam quisque rhoncus semper sodales varius viverra volutpat".split())
LATIN_SHARED = frozenset("dolor sit sed do magna ad minim quis ex ea in non qui culpa officia id est ac at vel a eu et ut nec nisi esse sint enim velit semper tempor labore anim varius nulla".split())
_OWN_LATIN, _ALL_LATIN = LATIN - LATIN_SHARED, LATIN | LATIN_SHARED
CHROME = re.compile(r"^(?:(?:menu|entrar|ajuda|inicio|home|login|sair|contato|busca|sobre|faq|help|search|about|contact)\b[ |>·•]*){2,}|^(?:ref|codigo de referencia|id da requisicao|request id|incidente|incident|trace id)\b|todos os direitos reservados|all rights reserved|politica de privacidade|privacy policy|termos de uso|terms of (?:use|service)|fale conosco|contact us|voltar ao inicio|back to (?:home|top)|\bnginx\b|\bapache\b|fale com o suporte|se o problema continuar|copyright|\(c\) ?\d{4}")
TRAIL = re.compile(r"(?:[a-z]{2,20}(?: [a-z]{2,20})? \| ){2,}|^(?:[\w ]{2,20} ?[|>·•]){1,8} ?[\w ]{2,24}$")
#: Terms of a person's report. A unit with one of them tells of something and is content.
TOLD = frozenset(
    "eu ele ela eles elas minha meu nosso nossa disse falou avisou contou leu li reclamou mandou pediu pedimos tentei tentou ativei ativou liguei ligou consegui conseguiu cliente lead segurado segurada vizinho vizinha cunhado cunhada familia atendente corretor corretora vistoriador gerente supervisora motorista condutor oficina equipe dono quem anotou abriu funcionou resolveu caiu mas embora"
    " i he she we they my our his her said told tried asked showed had got worked but client driver broker agent insured neighbour surveyor workshop yo ella dijo pidio intente logro pero taller perito asegurada agencia asesor dueno hermano".split()
)
#: A unit is a machine's message if at least this share of its words stands in such terms, and filler at this one.
ERROR_SHARE, FILLER_SHARE = 1 / 80, 0.5
#: Machines that are named after people.
MACHINES = frozenset("portal site pagina sistema aplicativo app area page system server sitio".split())
_MACHINE = re.compile(rf"\b(?:{'|'.join(sorted(MACHINES))}) (?:d[oae]s?|del|for|of) \w+")
#: Function words of Portuguese, Spanish and English, folded; a sentence hardly does without any.
FUNCTION = frozenset(
    "o a os as um uma uns umas de do da dos das em no na nos nas por pelo pela pelos pelas para pra com sem sob sobre entre ate e ou mas que quem se ao aos nao sim ja mais muito muita eu ele ela voce vc eles elas meu minha seu sua nosso nossa este esta esse essa isso isto aquele foi e era ser sao esta estao tem ter ha vai vou como quando onde porque"
    " el la los las unos unas del al con sin y pero lo le les me te mi su sus es son fue esta estan hay muy donde cuando porque este ese eso ya no ni si yo"
    " the an of to in on at by for with from and or but not is are was were be been has have had do does did will would can could it its this that these those he she they we you i my your his her their our as if than then there so no".split()
)
#: A word of a placeholder text stands in at least this many different units, this share of its units holds no function
#: word, and it's followed by at most this many different words. Units of fewer than LEAST_BARE words aren't counted.
OWN_UNITS, OWN_SHARE, OWN_FOLLOWERS, LEAST_BARE = 3, 0.9, 200, 4
#: A unit is filler if at least this share of its words are of that kind.
OWN_IN_UNIT = 0.5
#: Log odds of an open unit: what it starts with, and what each of its words adds besides its own odds. A long unit that
#: no other document explains is content, a short one is a heading.
OPEN_START, OPEN_WORD = 1.0, -0.1
#: Added to a word's share of either side's units, so a word that neither has counts for nothing.
RARE = 0.002
#: Log odds of words are kept in this many ranges of their hash, so what is broadcast is bounded.
RANGES = 1 << 18
#: A learned response: documents of a source that hold it, share of them that are responses, and log odds at least.
LEARNED_DOCS, LEARNED_SHARE, LEARNED_ODDS = 3, 0.2, 2.0
_SPLIT = re.compile(r"\n+|(?<=[.!?…])\s+|\s+[-–]\s+")
_LEAD = re.compile(r"^(?:[\s<>\-–*•|.]+|\[[a-z]{2,12}\]|(?:corretora|cliente|agente|lead|agent|client|atendente):)+\s*")
_THREE = re.compile(r"[^\W_][\W_]*[^\W_][\W_]*[^\W_]")
_WORD = re.compile(r"[a-z]+")
_LETTERS_OR_MARKS = re.compile(r"[a-z\0]+")
_NUMBER = re.compile(r"\d+")
_NO_WORD = re.compile(r"[\W_]+")
_HEX = re.compile(r"\b(?=[a-f]*\d)[0-9a-f]{6,}\b")


def has_slot(text: str) -> bool:
    """True if the folded text holds an unfilled slot."""
    return any(sign in text and p.search(text) for sign, p in SLOTS)


def units(text: str) -> list[str]:
    """Trimmed lines and sentences of a folded text without speaker marks; none for blank texts."""
    out = []
    for u in _SPLIT.split(text):
        lead = _LEAD.match(u)
        u = " ".join((u[lead.end() :] if lead else u).split())
        if _THREE.search(u):
            out.append(u)
    return out


def covered(u: str, *terms: re.Pattern[str], among: frozenset[str] = frozenset()) -> float:
    """Share of a unit's words that stand, wholly or in part, in a match of `terms` or are `among` the given ones; 1 if a unit without letters matches."""
    marked = u
    for t in terms:
        marked = t.sub(lambda m: re.sub("[a-z]", "\0", m[0]), marked)
    words = _LETTERS_OR_MARKS.findall(marked)
    return sum("\0" in w or w in among for w in words) / len(words) if words else 1.0


def judge(u: str) -> str:
    """'r' for a response, 'c' for what a person tells, 'f' for page furniture, '?' if the unit alone doesn't tell."""
    words = _WORD.findall(u)
    latin = frozenset() if _OWN_LATIN.isdisjoint(words) else _ALL_LATIN
    told = TOLD - latin if latin else TOLD
    if not told.isdisjoint(words):
        if MACHINES.isdisjoint(words):
            return "c"
        words = _WORD.findall(_MACHINE.sub(" ", u))
        if not told.isdisjoint(words):
            return "c"
    if (ERROR.search(u) or SCRIPT.search(u)) and covered(u, ERROR, SCRIPT) >= ERROR_SHARE:
        return "r"
    if (latin or FILLER.search(u)) and covered(u, FILLER, ERROR, SCRIPT, CHROME, among=latin) >= FILLER_SHARE:
        return "r"
    if CHROME.search(u) or (("|" in u or ">" in u or "·" in u) and TRAIL.search(u)):
        return "f"
    return "?"


def _skeleton(u: str) -> str:
    if _NUMBER.search(u):
        u = _NUMBER.sub("0", _HEX.sub("0", u))
    return _NO_WORD.sub(" ", u).strip()


def judged(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """key, source, text_id (same for equal texts of a source), slot, responses and contents (numbers of units), units (its different units, one a line: the verdict's letter and the skeleton)."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, str] = {}
        for b in batches:
            rows = []
            for k, host, t in zip(b["key"], b["source"], b["text"]):
                if not t or t.isspace():
                    rows.append((k, host, b"", False, 0, 0, ""))
                    continue
                p = folded(plain(t))
                found = []
                for u in units(p):
                    v = memo.get(u)
                    if v is None:
                        if len(memo) > 200_000:
                            memo.clear()
                        v = memo[u] = judge(u) + _skeleton(u)
                    found.append(v)
                verdicts = [v[0] for v in found]
                text_id = hashlib.blake2b(f"{host}\0{p}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                rows.append((k, host, text_id, has_slot(p), verdicts.count("r"), verdicts.count("c"), "\n".join(dict.fromkeys(found))))
            yield pd.DataFrame(rows, columns=["key", "source", "text_id", "slot", "responses", "contents", "units"])

    host = F.coalesce(F.col(source).cast("string"), F.lit("")) if source in documents.columns else F.lit("")
    rows = documents.select(F.col(key).alias("key"), host.alias("source"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(run, f"key {kind}, source string, text_id binary, slot boolean, responses int, contents int, units string")


def _laid_out(rows: DataFrame, *columns) -> DataFrame:
    """A row for each unit: the columns, v (verdict) and u (skeleton)."""
    lines = rows.where("units <> ''").select(*columns, F.explode(F.split("units", "\n")).alias("line"))
    return lines.select(*[c for c in lines.columns if c != "line"], F.substring("line", 1, 1).alias("v"), F.expr("substring(line, 2)").alias("u"))


def _hashed(u: str = "u") -> list[Column]:
    """Two hashes that together name a unit in joins."""
    return [F.xxhash64(u).alias("h"), F.xxhash64(F.lit(1), F.col(u)).alias("g")]


def _own_words(bare: DataFrame, words: DataFrame) -> DataFrame:
    """The words of placeholder texts. `bare` has the words of units without function words, `words` the counts of all."""
    follow = F.expr("transform(sequence(1, size(words) - 1), i -> struct(words[i - 1] AS word, words[i] AS next))")
    pairs = bare.where(f"size(words) >= {LEAST_BARE}").select(F.explode(follow).alias("p")).select("p.*").groupBy("word", "next").agg(F.count(F.lit(1)).alias("n"))
    few = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("followers")).where(F.col("followers") <= OWN_FOLLOWERS)
    return words.where((F.col("bare") >= OWN_UNITS) & (F.col("bare") >= OWN_SHARE * F.col("counted"))).join(few, "word").select("word")


def _odds(words: DataFrame) -> DataFrame:
    """spot (range of the word's hash), ours and others (numbers of distinct units of responses and of other documents); at most RANGES rows."""
    return words.groupBy(_spot("word").alias("spot")).agg(F.sum("ours").alias("ours"), F.sum("others").alias("others"))


def _spot(word: str) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(RANGES)).cast("int")


def residue(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", share: float = 0.5) -> DataFrame:
    """One row per input row: key, slot, response (true if it consists of responses), is_case.

    `share`: an open unit belongs to responses only if at least this share of the documents of its source that hold it
    have a response and no content of their own; every document counts. Null, empty and blank texts aren't cases.
    Without a column `source`, or where it's null, all documents are of one source. Repeated rows get a row each; null
    keys stay. Extra columns are ignored. An empty table gives an empty result.
    """
    rows = written(judged(documents, key, text, source), "residue")
    ours = (F.col("responses") > 0) & (F.col("contents") == 0)
    pieces = _laid_out(rows.where("NOT slot"), "source", ours.alias("ours"), (F.col("responses") > 0).alias("responds"))
    held = pieces.groupBy("source", "u", "v").agg(F.count(F.lit(1)).alias("n"), F.count_if("ours").alias("k"), F.count_if("responds").alias("r"))
    held = written(held, "residue-units")
    plain_words = F.array(*[F.lit(w) for w in sorted(FUNCTION)])
    distinct = held.groupBy("u", "v").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("r").alias("r")).withColumn("words", F.split("u", " "))
    distinct = distinct.withColumn("bare", ~F.arrays_overlap("words", plain_words))
    distinct = written(distinct, "residue-distinct")
    each = distinct.select("v", "k", "r", "bare", F.size("words").alias("size"), F.explode(F.array_distinct("words")).alias("word"))
    long_ = F.col("size") >= LEAST_BARE
    words = each.groupBy("word").agg(F.count_if(F.col("k") > 0).alias("ours"), F.count_if(F.col("r") == 0).alias("others"), F.count_if(long_).alias("counted"), F.count_if(long_ & F.col("bare")).alias("bare"))
    words = written(words, "residue-words")
    own = _own_words(distinct.where("bare AND v = '?'"), words)
    filler = (
        distinct.where("bare AND v = '?'").select("u", F.explode(F.array_distinct("words")).alias("word")).join(own.withColumn("own", F.lit(1)), "word", "left")
        .groupBy("u").agg((F.sum(F.coalesce("own", F.lit(0))) / F.count(F.lit(1))).alias("part")).where(F.col("part") >= OWN_IN_UNIT).select("u", F.lit(True).alias("filler"))
    )
    all_ours, all_others = distinct.agg(F.count_if(F.col("k") > 0), F.count_if(F.col("r") == 0)).first()  # two numbers
    here = (F.col("ours") - 1) / F.lit(max(all_ours - 1, 1))
    there = F.col("others") / F.lit(max(all_others, 1))
    odds = F.log((here + RARE) / (there + RARE))
    table = F.broadcast(_odds(words))  # at most RANGES rows
    scored = distinct.where("v = '?' AND k > 0").select("u", F.explode(F.array_distinct("words")).alias("word")).withColumn("spot", _spot("word")).join(table, "spot").groupBy("u").agg((F.sum(odds + OPEN_WORD) + OPEN_START).alias("score"))
    settled = (
        held.where("v = '?'").join(filler, "u", "left").join(scored, "u", "left")
        .select("source", *_hashed(), F.coalesce("filler", F.lit(False)).alias("filler"), F.coalesce("score", F.lit(0.0)).alias("score"), (F.col("k") / F.col("n")).alias("part"), "n")
    )
    learned = (F.col("n") >= LEARNED_DOCS) & (F.col("part") >= LEARNED_SHARE) & (F.col("score") >= LEARNED_ODDS)
    bad = F.col("filler") | learned
    settled = settled.select("source", "h", "g", bad.alias("bad"), (~bad & ((F.col("part") < share) | (F.col("score") < 0))).alias("good"))
    asked = _laid_out(rows.where("contents = 0 AND NOT slot"), "text_id", "source").where("v = '?'").select("text_id", "source", *_hashed())
    shown = asked.join(settled, ["source", "h", "g"]).groupBy("text_id").agg(F.max("bad").alias("bad"), F.max("good").alias("good"))
    done = rows.select("key", "text_id", "slot", "responses", "contents").join(shown, "text_id", "left")
    response = (F.col("contents") == 0) & ((F.col("responses") > 0) | F.coalesce("bad", F.lit(False))) & ~F.coalesce("good", F.lit(False)) & ~F.col("slot")
    return done.select(F.col("key").alias(key), "slot", response.alias("response"), (F.col("slot") | response).alias("is_case"))


def without_residue(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of `documents` that aren't cases, all columns as they are."""
    bad = residue(documents, key, text, source).where("is_case").select(F.col(key).alias("__residue_key")).distinct()
    return documents.join(bad, documents[key].eqNullSafe(bad["__residue_key"]), "left_anti")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("is_case").select("doc_id").distinct()
