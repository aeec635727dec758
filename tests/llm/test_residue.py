import pytest

from talkmill.llm import residue as r
from talkmill.llm.textnorm import folded, plain

SLOTS = ["Olá {{ nome }}!", "Prezado(a) {nome_do_cliente},", "vale até %%vencimento%%", "Dear [[FIRST NAME]], hi", "<%= placa %>", "{% if marca %}", "O prêmio é de R$ ________.", "em XX/XX/XXXX", "R$ XX,XX", "Olá [●]", "oi %s, tudo", "{0}", "Titular: undefined | ativa", "Prezado(a) NaN, segue", "(preencher cidade)", "[inserir NOME]", "[placa aqui]", "«Cidade»", "${valor}", "@{x}", "*|NOME|*", "$marca$", "#cidade#", "__DATA__", "<nome>", "conforme combinado com ........", "[object Object]"]
NONE = ["Cores: {azul, prata, preto}", 'Nota: {"franquia": 12, "vidros": true}', "Ver [anexo 2] e o item <3>.", "[risos] disse [ruído de trânsito]", "***.***.***-** está certo", "placa ***1D**", "[agente] oi [lead] tchau", "<b>negrito</b>", "Ganhou 10% de bônus e #seguroauto virou", "R$ 1.234,56", "fim...", "a <|endoftext|> b", "anulou o contrato", "custa $50 ou $60", "e-mail a_b@c.de"]


@pytest.mark.parametrize("text", SLOTS)
def test_slots(text):
    assert r.has_slot(folded(plain(text)))


@pytest.mark.parametrize("text", NONE)
def test_no_slots(text):
    assert not r.has_slot(folded(plain(text)))


def found(spark, texts, **extra):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for k, v in extra.items():
        df = df.selectExpr("*", f"{v} AS {k}")
    return {x["doc_id"] for x in r.residue(df).where("is_case").collect()}


def test_documents(spark):
    bad = ["Erro 404: página não encontrada", "Menu  Entrar  Ajuda\nTempo limite excedido\nTodos os direitos reservados", "You need to enable JavaScript to run this app.", "lorem ipsum, asdf asdf, texto de exemplo", "HTTP 502 - Bad Gateway nginx", "O portal do corretor recusou a conexão.", "Antes de seguir, ative o JavaScript e recarregue"]
    fine = ["O cliente mandou um print com erro 500 ao abrir o boleto.", "Minha sessão expirou duas vezes, mas consegui enviar.", "Ela disse que o texto de exemplo era confuso.", "Achei o atendimento ótimo, recomendo!", None, "", " \n\t", "Erro 404: página não encontrada\nO cliente ligou e a oficina resolveu tudo.", "A oficina resolveu tudo. " * 20_000]
    assert found(spark, bad + fine, slot="1", response="2", key="3", unit="4") == set(range(len(bad)))


def test_unknown_furniture_is_settled_by_all_documents(spark):
    texts = [f"Zona Azulada Prime\nErro {500 + i}: falha interna" for i in range(5)] + ["Bela Vista Florida\nErro 500: falha interna"] + ["Bela Vista Florida"] * 5
    assert found(spark, texts) == {0, 1, 2, 3, 4}


def test_repeated_null_and_empty(spark):
    df = spark.createDataFrame([(None, "lorem ipsum"), (1, "lorem ipsum"), (1, "lorem ipsum")], "doc_id long, text string")
    assert r.residue(df).where("is_case").count() == 3
    assert r.without_residue(df.unionByName(spark.createDataFrame([(2, "A oficina resolveu.")], df.schema))).count() == 1
    assert r.residue(df.where("false")).count() == 0


def test_filler_and_messages_of_any_length_without_punctuation(spark):
    bad = ["Lorem ipsum a definir rascunho vazio", "sample text título aqui a definir substituir este trecho 123 testando rascunho vazio", "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.", "erro 500 falha interna tente novamente mais tarde " * 40, "lorem ipsum " * 100_000]
    fine = ["O anúncio mostrava lorem ipsum no lugar do preço e do nome da seguradora", "A franquia do plano cobre vidros faróis e retrovisores " * 30 + "quando o navegador fecha", "El dolor de espalda es culpa del choque y no sed de dinero", "Do ponto de vista da apólice, a culpa é sem efeito"]
    assert found(spark, bad + fine) == set(range(len(bad)))


def test_made_up_filler_is_told_by_its_own_vocabulary(spark):
    import random

    r = random.Random(1)
    own = ["".join(r.choice("bdfglmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(14)]
    made = [" ".join(r.choices(own, k=8)) + ". " + " ".join(r.choices(own, k=5)) + "." for _ in range(12)]
    other = [f"a {a} do {b} cobre {c} sem franquia" for a in ("apolice", "proposta") for b in ("carro", "seguro", "plano") for c in ("vidros", "farol", "teto")]
    repeated = ["muito obrigada, voltem sempre"] * 6 + ["placa renavam chassi cor"] * 6  # no function words, but no recombination
    assert found(spark, made + other + repeated) == set(range(len(made)))


def test_unlisted_message_is_learned_from_repeats_and_terms(spark):
    texts = [f"Sistema em repouso {x}\nErro 500: falha interna" for x in ("agora", "agora", "agora", "outra vez", "por horas")] + ["Sistema em repouso agora"] * 4
    other = [f"O carro {x} ficou na garagem" for x in ("azul", "novo", "velho")] * 3
    assert found(spark, texts + other) == set(range(9))


def test_long_open_unit_beside_a_message_is_content(spark):
    others = [f"a renovacao da apolice {i} ficou pronta e a vistoria do carro foi marcada para o dia seguinte na unidade" for i in range(5)]
    mixed = "a renovacao da apolice ficou pronta e a vistoria do carro foi marcada para outro dia na unidade\nErro 404: página não encontrada"
    assert found(spark, [*others, mixed, "Erro 404: página não encontrada\n保险车辆报价"]) == {6}


def test_no_length_limit_on_slots(spark):
    assert found(spark, ["Olá {{ " + "nome_" * 100 + " }}", "{% if " + "x" * 500 + " %}"]) == {0, 1}
