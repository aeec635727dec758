import pytest

from talkmill.llm import pii
from talkmill.llm.pii_table import labelled_rows


@pytest.fixture(scope="module")
def crf():
    return pii.model()


def test_accuracy_on_wordings_streets_and_hosts_held_out_from_training():
    precision, recall = pii.accuracy(pii.model(held=False), labelled_rows(1500, seed=4711, held=True))
    assert precision > 0.94 and recall > 0.94


def test_accuracy_on_other_rows_of_the_same_parts(crf):
    precision, recall = pii.accuracy(crf, labelled_rows(1500, seed=4711))
    assert precision > 0.97 and recall > 0.97


def test_no_pattern_is_a_message_of_the_test_tables():
    import os

    import pandas as pd

    at = "/root/testdata/sf0.01/bronze.parquet"
    if not os.path.exists(at):
        pytest.skip("no test tables")
    bodies = {b.strip() for b in pd.read_parquet(at, columns=["message_body"]).message_body.dropna()}
    long = [t for t, items in labelled_rows(3000, seed=5) if not items and len(t.split()) > 4]
    assert len(long) > 300 and not bodies & {t.strip() for t in long}


@pytest.mark.parametrize(
    ("text", "items"),
    [
        ("meu cpf é 231.986.294-70", [("id_number", "231.986.294-70")]),
        ("rg MG-49.458.749", [("id_number", "MG-49.458.749")]),
        ("me liga no (26) 92798-7089 🙏", [("phone", "(26) 92798-7089")]),
        ("zap 2 5 9 7 0 4 4 0 9 3 2", [("phone", "2 5 9 7 0 4 4 0 9 3 2")]),
        ("manda pra ana.b @ cartas.example", [("email", "ana.b @ cartas.example")]),
        ("moro na Rua das Palmas, 977, fundos", [("address", "Rua das Palmas, 977, fundos")]),
        ("a rua aqui é sem saída", []),
        ("meu cep é 83065-540", []),
        ("o protocolo que me passaram foi 20250122641392", []),
        ("Oi, Joana! Tudo bem?", [("name", "Joana")]),
        ("moro em Porto Beatriz, o carro dorme na garagem", []),
        ("", []),
        ("   ", []),
    ],
)
def test_items(crf, text, items):
    assert [(k, text[a:b]) for a, b, k in pii.find_items(crf, [text])[0]] == items


def test_viterbi_against_brute_force(crf):
    import itertools

    import numpy as np

    sigs = [pii.signature(t[a:b], k) for t in ["oi Ana Bo"] for a, b, k in pii.tokens(t)]
    best = crf.decode([sigs])[0]
    e = crf.emissions(np.array([[crf.number[s] for s in sigs]]))[0]
    trans = crf.transitions + pii.FORBIDDEN

    def score(path):
        return pii.START[path[0]] + sum(e[i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:]))

    want = max(itertools.product(range(len(pii.LABELS)), repeat=len(sigs)), key=score)
    assert abs(score(want) - score(best)) < 1e-3


SCHEMA = "conversation_id string, message_id string, message_body string, pii_kind int, pii_text int, k0 int, c0 int, text int"


def test_tables(spark):
    long = "bla " * 60_000 + "meu cpf é 231.986.294-70"
    rows = [("c", "1", "cpf 231.986.294-70 e cpf 231.986.294-70", 1, 1, 1, 1, 1)] * 2 + [("c", "2", long, 1, 1, 1, 1, 1), ("c", "3", None, 1, 1, 1, 1, 1), ("c", "4", "", 1, 1, 1, 1, 1), (None, "5", "cpf 231.986.294-70", 1, 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in pii.personal_items(df).collect())
    assert got == [("c", "1", "id_number", "231.986.294-70"), ("c", "2", "id_number", "231.986.294-70")]
    done = pii.redact(df)
    assert done.columns == df.columns and done.count() == 6
    bodies = {r["message_id"]: r["message_body"] for r in done.collect()}
    assert bodies["1"] == "cpf [ID_NUMBER] e cpf [ID_NUMBER]" and bodies["2"].endswith("é [ID_NUMBER]") and bodies["3"] is None and bodies["4"] == ""
    assert pii.personal_items(df.where("false")).count() == 0 and pii.redact(df.where("false")).count() == 0


def test_the_rows_own_phone_is_found_however_it_is_written(spark):
    rows = [("c", "1", "codigo 11 9 8765 4321 xx", "+55 (11) 98765-4321"), ("c", "2", "codigo 11 9 8765 4321 xx", "11 3333-4444"), ("c", "3", None, "11 3333-4444"), ("c", "4", "fale no 11 98765-4321", None)]
    df = spark.createDataFrame(rows, "conversation_id string, message_id string, message_body string, sender_phone string")
    with_own = {(r["message_id"], r["pii_text"]) for r in pii.personal_items(df).where("pii_kind = 'phone'").collect()}
    assert {("1", "11 9 8765 4321"), ("4", "11 98765-4321")} <= with_own
    assert pii._with_own("ref 11987654321 fim", [], "87654321") == [(4, 15, "phone")] and pii._with_own("ref 11987654321 fim", [], "") == []
    assert pii.redact(df).count() == 4 and pii.personal_items(df.drop("sender_phone")).count() >= 1
