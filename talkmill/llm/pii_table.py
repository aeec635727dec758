"""The labelled table from which the tagger of personal information is trained: texts made by rule, with marked items.

A text is one or several clauses. A clause is an opening, an item of a kind (`{kind:slot}`) or an unmarked filler
(`{slot}`), and a closing, each drawn from its list; other clauses have no item at all. Slots are filled by rule, and a
text is typed in one of several ways (as written, lower case, upper case, without accents, with a chat tail).

For measuring, every fifth opening, closing, plain clause, street word, place and host (by a hash of it) can be held
out, so that a field is tested on wordings, streets and orders of items that it never saw.
"""

from __future__ import annotations

import random
import unicodedata
import zlib

from talkmill.llm.names import GIVEN, NICKNAMES

#: What stands before and after an item, by the item's slot. `|` separates them.
OPENINGS = {
    "name:full": "o cadastro fica em nome de |anota aí: |falo em nome de |assinado por |contratante: |nome do segurado: |quem vai dirigir é |condutor principal: |é do meu marido, |é da minha mãe, |é para o meu filho |nome completo |o nome é |documento de |eu sou |me chamo |sou |sou a |sou o |titular |a proprietária é |está registrado em nome de |no nome do meu pai, |no nome da |cordialmente, |abraços, |grato, |att. |ass: |cliente |segurada |beneficiário: |indicação de |recado de |o outro motorista era |||",
    "name:any": "boa noite, |boa tarde, |bom dia, |oi |Oi, |olá, |Olá |alô |prezada |Prezado |caro |sr. |Sr. |sra. |dona |Dona |seu |dr. |quem escreve é |quem fala é a |aqui fala |aqui é a |aqui é o |pode me chamar de |me chamam de |conversei ontem com |deixei tudo com |peça para |falar com |chame a |é a |ligue para |passo para |obrigado, |obrigada |valeu |tchau, |amanhã quem atende é |sua consultora será |meu colega |minha colega |||",
    "id_number:cpf": "cpf |CPF: |Cpf |cpf do titular |segue o cpf |número do cpf: |cpf nº |o cpf dela é |o cpf dele: |meu documento |documento do condutor: |inscrita no cpf |confirmo o cpf |doc |o meu é |||",
    "id_number:rg": "rg |RG: |Rg |identidade: |minha identidade é |registro geral |carteira de identidade |rg do condutor |documento |documento: |o rg é |doc. |",
    "id_number:cnh": "cnh |CNH nº |CNH |carteira de motorista |habilitação nº |número da habilitação |registro da cnh: |a cnh é |minha carteira é ",
    "phone:phone": "liga no |liga pra |telefone |telefone: |fone: |fone |cel |celular: |whatsapp |whats |zap |meu zap |me chama no |contato: |contato |retorne para |tel. |recado no |ramal |meu ramal é o |outro número: |do trabalho: |tentei o |número novo |anota meu número: |||||",
    "email:email": "e-mail |email |Email: |mande no |manda pro |escreva para |envia o boleto para |Enviado para |correio: |meu endereço eletrônico é |copie |o dela é ||||",
    "address:address": "resido na |moro na |moramos na |o endereço é |endereço |entregar na |fico na |vistoria na |A vistoria é na |endereço: |pernoita na |o carro dorme na |trabalho na |mudei para a |guincho na |estou parado na |minha casa é na |oficina na |fica na ||||",
}
CLOSINGS = {
    "name:full": "|||, por gentileza|, certo?| vai buscar o carro| é o dono|, {small} anos de carteira|, mãe do {name:given}|, mora comigo|, corretor| me passou seu contato|, e meu cunhado {name:given} também dirige|.|, correto?| aqui|, pode pôr|, tudo bem?| e {name:given}| e {name:given} está junto| do balcão",
    "name:any": "||!|! Como está?|? Consegue falar agora?|, tudo certo?|, da oficina|, do balcão|, recebi sua mensagem|, já mandei a cotação|, tentei contato sem sucesso| e a {name:given}|, esposa do {name:given}|, segue o link|, aguardo|, ok?| pra mim|, obrigado| de novo|.|, e o meu pedido?| do financeiro| da recepção| do setor de vistoria| da loja, ok?| do escritório, pode ser?| da corretora| do seguro| e o {name:given}",
    "id_number:cpf": "|||, confere?| é esse| do titular| é o número|, nascimento {date}| e o cep {cep}| nasc. {date}|, pedido {order}|, certo?|.",
    "id_number:rg": "|||| ssp|, órgão ssp|, expedido {date}|, confere?|.",
    "id_number:cnh": "|||, categoria B|, validade {date}|, vence {date}| vencendo em {date}|.",
    "phone:phone": "|||| à tarde| depois das {small}h| depois do almoço| falar com {name:any}|, é da minha esposa| (recado)|, por favor|?| só mensagem| e não atende.|, pode chamar.|.| qualquer hora",
    "email:email": "|||| por favor| ou para {email:email}| ou no outro {email:email}|, obrigado|.| e me avisa|, confirma?",
    "address:address": "||||, perto da padaria|, ao lado da escola|, bairro {word}|, {city}| - {city}|, cep {cep}| cep {cep}| - cep {cep}|, amanhã cedo|?|, dia {date}|, {city}, cep {cep}| ou na {address:address}|.",
}
#: Numbers that mean nothing without their label.
LABELLED = ("id_number:rg", "id_number:cnh")
#: Clauses without an item.
PLAIN = """
protocolo {protocol}|meu protocolo era {protocol}|chamado {protocol} aberto|atendimento nº {protocol}|pedido {order}|o pedido {order} sumiu|compra {order} paga|número da compra: {order}|apólice {policy}|apólice nº {policy} vencendo|renova a {policy}|renavam {order}|código renavam {order}
nota {invoice}|nota fiscal {invoice} da peça|tabela fipe {fipe}|fipe código {fipe}|código de barras {boleto}|linha digitável {boleto}|o boleto é {boleto}|cotação {protocol} feita|placa {plate}|a placa é {plate}|carro placa {plate} parado|veículo {plate}|cep {cep}|meu cep: {cep}|o cep da garagem é {cep}|valor {price}|pago R$ {price} hoje|sai por {price} no ano
em {small} parcelas de R$ {price}|R$ {price} à vista|rodei {km} mil km|faço {km} km por mês|modelo {year}|{car} {year}|é {car} {year}|{car} {year} {year}|{car} ano {year} {year}|{car} prata {year} {year}|{car} preto {year}, completo|tenho um {car}|meu carro: {car} ano {year}|O {car} {year} sai por R$ {price}|troquei por {car}|vence dia {date}|vale a partir de {date}|marcado para {date} às {small}h|viajo em {date}|{small} dias de reserva
guincho 24h|aqui em {city}|moro em {city}|sou de {city}|nasci em {city} e vivo em {city}|vim de {city}|viajo de {city} para {city}|a {firm} cobrou {price}|sou cliente da {firm}|a {firm} ofereceu desconto|comparei com {firm}|vi o anúncio @{firm}|saí da {firm} em {date}|na {firm} era R$ {price}|a {firm} é mais barata?|vendo com a {firm}|cobertura igual à da {firm}
a rua alagou ontem|estaciono numa rua sem saída|a loja fica numa avenida larga|bati perto da praça|a oficina da avenida fechou|a travessa ao lado é tranquila|uma alameda arborizada|rua do comércio, perto da ponte|passei pela estrada nova|deixo na rua durante o dia|qual rua? a do mercado|no largo da feira, serve?
"""
#: What numbers are called, those that are items and those that aren't, and what joins name and number.
NOUNS = {
    "id_number:cpf": "cpf|CPF|Cpf|documento", "id_number:rg": "rg|RG|identidade|registro geral|documento", "id_number:cnh": "cnh|CNH|habilitação|carteira", "phone:phone": "telefone|fone|celular|cel|zap|whats|whatsapp|ramal|contato|número", "email:email": "email|e-mail|correio|endereço eletrônico",
    "order": "pedido|compra|encomenda|renavam|código do cliente|matrícula", "protocol": "protocolo|chamado|atendimento|ocorrência|cotação|senha", "policy": "apólice|contrato|proposta|endosso", "invoice": "nota fiscal|nota|nf|recibo|cupom", "fipe": "fipe|tabela fipe|código fipe", "boleto": "boleto|linha digitável|código de barras|fatura", "cep": "cep|CEP|código postal", "plate": "placa|Placa|emplacamento",
}
WHOSE = ["", "", "", "meu ", "minha ", "Meu ", "Minha ", "o ", "a ", "o número do ", "segue o ", "nosso ", "esse é o ", "qual o "]
WHICH = ["", "", "", "", " novo", " antiga", " antigo", " direto", " atual", " dela", " do titular", " que me deram", " da empresa", " certo", " da peça", " daqui"]
JOINED = [" ", " ", ": ", " é ", " é ", " é o ", " nº ", " foi ", " número ", " - ", " seria ", ", "]
ENDED = ["", "", "", "", ".", "?", ", e agora?", " sem resposta", ", ainda sem retorno", " não chegou", ", confere?", ", pode ver", " desde {date}", " por favor", ", anotou?", " até sexta"]
#: What is said of a firm with a price.
OFFERS = "a {firm} pede {price}|a {firm} quer {price}|na {firm} deu {price}|{firm} por {price}|{price} na {firm}|{firm} cobra {price}, vale?|a {firm} fez {price} no ano|achei por {price} com a {firm}|{price} é muito|deu {price} à vista|{price}, consegue baixar?|pagava {price} na {firm}, subiu|página @{word}.{word}|siga @{word}|vi no @{word}.{word} de vocês|a rede @{firm} é de vocês?".split("|")
SUBJECTS = "o carro|a seguradora|o guincho|a vistoria|o boleto|a oficina|meu vizinho|a franquia|o vidro|o motor|a proposta|o prazo|a garagem|minha família|o corretor|minha esposa|meu pai|o sinistro|a cobertura|o outro motorista".split("|")
VERBS = "ficou|chegou|demorou|atrasou|mudou|precisa|cobre|não cobre|custa|venceu|está|vai|bateu|pediu|quer ver|inclui".split("|")
OBJECTS = "ontem|na sexta|desconto|revisão|o farol|o para-brisa|terceiros|pouco|no estacionamento|cedo|hoje|o freio|carro reserva|assistência|uma semana|mais barato|para trabalhar|de novo|sem juros|à vista".split("|")
ASKED = "quanto fica|quanto custa|dá para|tem como|posso|vocês|quando|qual|qual a marca e o ano de|já teve|ainda quer|bom dia, quero cotar|oi, preciso de|olá, vi que pediu|perfeito, vou calcular|obrigado, recebi|sem problema|segue o link de|ok, combinado|vou pensar sobre|me explica|fechado, pode mandar|confere por favor|recebi|alô ...|certo".split("|")
NOTED = ["", "", "", "", "", "[risada] ", "[barulho de carro] ", "(sem áudio) ", "é... ", "hum, ", "então, ", "[chiado] "]
#: Words of streets, units and places.
STREETS = "Rua,R.,Avenida,Av.,Av,Alameda,Al.,Travessa,Tv,Tv.,Praça,Pç.,Estrada,Est.,Rodovia,Rod.,Largo,Viela,Beco,Ladeira,Via,Vila".split(",")
#: Nouns and numbers of which names of streets are made.
OF = "das Acácias,dos Jasmins,dos Coqueiros,do Operário,da Fonte,do Porto Antigo,da Estação,dos Marinheiros,da Paz,do Cruzeiro,das Oliveiras Bravas,da Serra Alta,do Bosque,dos Pescadores,da Alegria,do Engenho,das Pedras Brancas,da Igreja,do Trilho,dos Lírios".split(",")
DAYS = "Dois,Três,Cinco,Oito,Nove,Onze,Doze,Quinze,Dezoito,Vinte,Vinte e Dois,Vinte e Cinco,Vinte e Oito,Trinta,Trinta e Um".split(",")
MONTHS = "Janeiro,Fevereiro,Junho,Julho,Agosto,Setembro,Outubro,Dezembro".split(",")
SAINTS = "São,Santo,Santa,Nossa Senhora,Bom Jesus".split(",")
RANKS = "Doutor,Doutora,Coronel,Marechal,Padre,Professor,Professora,Dom,Dona,General,Capitão,Engenheiro,Dr.,Prof.".split(",")
UNITS = "apto {n},ap {n},ap. {n},apartamento {n},casa {n},bloco {n},bl {n},fundos,sala {n},loja {n},cj {n},conjunto {n},sobrado,térreo,torre {n},bl {l},bloco {l},bl. {l}".split(",")
PLACES = "Nova {w},Novo {w},Serra {g},Campo {g},Rio {g},Nova {g},São {g},Santo {g},Santa {g},Monte {w},Monte {g},Campo {w},Porto {g},Porto {w},Vila {g},Vila {w},Serra da {w},Serra {w},Lagoa do {w},Lagoa {g},Rio {w},Cruz do {w},Boa {w},Ilha {g},Barra do {w},Vale do {g},Pedra {w},Ponte {g},Ribeirão {w},{w},{w} do Sul".split(",")
HOSTS = "exemplo.example,mail.{w}.test,{w}.example,{w}-{w}.example,{w}.invalid,{w}.com.br,{w}.com,post.{w}.net,caixa{w}.test,{w}mail.org".split(",")
TAILS = ["", "", "", "", "", " rs", " kkk", "!!", "...", "?", " 👍", " 🙏", " 😊", "\n", "."]


class Filler:
    """Fills slots from a seeded generator."""

    def __init__(self, seed: int, held: bool | None = None):
        self.r, self.held = random.Random(seed), held
        self.given = sorted(GIVEN)
        self.nick = sorted(k for k in NICKNAMES if len(k) > 2 or k in ("ze", "ju", "lu", "ge"))

    def pick(self, options: list[str]) -> str:
        """One of them: of all, or of those that are (not) held out, if there are such ones."""
        if self.held is None:
            return self.r.choice(options)
        return self.r.choice([x for x in options if held_out(x) == self.held] or options)

    def street(self) -> str:
        r, n = self.r, self.r.random()
        if n < 0.3:
            return self.pick(OF)
        if n < 0.43:
            return f"{self.pick(DAYS)} de {self.pick(MONTHS)}" if r.random() < 0.6 else self.pick(DAYS)
        if n < 0.49:
            return f"{self.pick(SAINTS)} {self.first()}"
        if n < 0.53:
            return f"{r.choice(['Bem', 'Sabiá', 'Tico', 'Beija'])}-{r.choice(['te', 'do', 'da'])}-{self.word(1, 2).lower()}"
        if n < 0.72:
            return f"{r.choice(RANKS)} {self.first()} {self.word(3, 4)}"
        if n < 0.82:
            return f"{r.choice(['do', 'da', 'dos', 'das'])} {self.word(2, 3)}" + (f" {self.word(2, 3)}" if r.random() < 0.5 else "")
        return f"{self.word(2, 4)} {self.word(2, 4)}" if r.random() < 0.5 else f"{self.first()} {self.word(2, 4)}"

    def word(self, least: int = 2, most: int = 5) -> str:
        onsets, vowels, ends = "b c d f g j l m n p r s t v z br tr pr cr dr fr pl gl qu x".split(), "aeiou", ["", "", "", "r", "l", "s", "n", "x"]
        return ("".join(self.r.choice(onsets) + self.r.choice(vowels) for _ in range(self.r.randint(least, most))) + self.r.choice(ends)).capitalize()

    def digits(self, shape: str) -> str:
        return "".join(self.r.choice("0123456789") if c == "d" else self.r.choice("123456789") if c == "D" else c for c in shape)

    def first(self) -> str:
        return self.r.choice(self.given).capitalize()

    def full(self) -> str:
        r, n = self.r, self.r.random()
        family = [self.word(3, 4)] + ([self.word(3, 5)] if r.random() < 0.55 else [])
        if n < 0.2:
            family.insert(0, r.choice("ABCDFGLMNPRSTVZ") + r.choice([".", "."]))
        elif n < 0.27:
            family.insert(len(family) - 1, r.choice(["de", "da", "dos", "e"]))
        elif n < 0.3:
            family.append(r.choice("ABCDFGLMNPRSTVZ") + r.choice([".", ""]))
        return " ".join([self.first() if r.random() < 0.93 else r.choice(self.nick).capitalize(), *family])

    def phone(self) -> str:
        p = self._phone()
        return p[:-3] + "O" + p[-2:] if self.r.random() < 0.02 and p[-3].isdigit() else p

    def _phone(self) -> str:
        r = self.r
        area = self.digits("DD")
        mobile = r.random() < 0.8
        a, b = ("9" + self.digits("dddd"), self.digits("dddd")) if mobile else (r.choice("2345") + self.digits("ddd"), self.digits("dddd"))
        n = r.random()
        if n < 0.1:
            return f"{a}-{b}"
        if n < 0.18:
            return " ".join(area + a + b)
        if n < 0.28 and mobile:
            return f"{area} {a[0]} {a[1:]} {b}"
        if n < 0.36:
            return f"55{area}{a}{b}"
        prefix = r.choice(["", "", "", "+55 ", "+55", "0xx", "(0", "55 "])
        if prefix == "0xx":
            return f"0xx{area} {a}-{b}"
        if prefix == "(0":
            return f"(0{area}) {a}{r.choice('.-')}{b}"
        return prefix + r.choice([f"({area}) {a}-{b}", f"({area}){a}{b}", f"{area} {a}-{b}", f"{area} {a} {b}", f"{area}{a}{b}", f"{area}.{a}.{b}", f"{area}/{a}-{b}", f"({area}) {a} {b}", f"{area}-{a}-{b}"])

    def email(self) -> str:
        r = self.r
        parts = [unicodedata.normalize("NFKD", self.first().lower()), self.word(2, 4).lower()]
        local = r.choice([".".join(parts), "-".join(parts), "_".join(parts), parts[0] + "+seguro", parts[0][0] + parts[1] + self.digits("DD"), parts[1] + "_" + parts[0][0], parts[0] + self.digits("dd")])
        host = self.pick(HOSTS).format(w=self.word(2, 3).lower())
        n = r.random()
        if n < 0.65:
            return f"{local}@{host}"
        if n < 0.73:
            return f"{local} @ {host}"
        if n < 0.81:
            return f"{local}{r.choice(['(at)', ' (at) ', '[at]'])}{host}"
        if n < 0.9:
            return f"{local} arroba {host.replace('.', ' ponto ')}"
        return f"{local} {r.choice(['[arroba]', '(arroba)'])} {host.replace('.', ' . ') if r.random() < 0.5 else host}"

    def address(self) -> str:
        r = self.r
        name = self.street()
        n = self.digits(r.choice(["Dd", "Ddd", "Dddd", "Dddd"]))
        number = r.choice([f", {n}", f" {n}", f", nº {n}", f" n {n}", f" número {n}", f", n. {n}", f", n° {n}", ", s/n", " s/n", f" nº {n}", ", sn"])
        unit = ""
        if r.random() < 0.3:
            unit = r.choice([", ", " ", " - "]) + r.choice(UNITS).format(n=self.digits(r.choice(["D", "Dd", "Ddd"])), l=r.choice("ABCDEF"))
        return f"{self.pick(STREETS)} {name}{number}{unit}"

    def fill(self, slot: str) -> str:
        r, d = self.r, self.digits
        if slot == "any":
            n = r.random()
            slot = "given" if n < 0.4 else "nick" if n < 0.7 else "full"
        if slot == "given":
            return self.first()
        if slot == "nick":
            return r.choice(self.nick).capitalize()
        if slot in ("full", "phone", "email", "address", "word"):
            return getattr(self, slot)()
        shapes = {
            "cpf": ["ddd.ddd.ddd-dd"] * 4 + ["ddddddddddd", "ddddddddd-dd", "ddd ddd ddd dd", "ddd.ddd.ddd/dd", "ddd-ddd-ddd-dd", "ddd.ddd.ddd dd", "ddd.ddd.ddd.dd"],
            "rg": ["dd.ddd.ddd-d", "dddddddd-d", "ddddddddd", "dd.ddd.ddd-X", "dddddddd-X", "ddddddddX", "MG-dd.ddd.ddd", "SP-dd.ddd.ddd", "dd.ddd.ddd", "MG-dddddddd"],
            "cnh": ["0dddddddddd", "ddddddddddd", "ddd.ddd.ddd-dd"], "cep": ["ddddd-ddd", "ddddd-ddd", "dddddddd", "dd.ddd-ddd"],
            "protocol": ["2025dddddddddd", "2025dddddddd", "dddddddddddddd"], "order": ["Dddddddddd d".replace(" ", "d"), "Ddddddddddd", "Ddddddddd"], "policy": ["dddd.d.dddddd-d", "ddddddd", "dd.ddd.dddddd"],
            "invoice": ["000.d.ddd", "000.ddd.ddd", "dddddd"], "fipe": ["dddddd-d"], "boleto": ["ddddd.ddddd ddddd.dddddd ddddd.dddddd d", "ddddd.ddddd ddddd.dddddd"], "date": ["Dd/0D/202d", "1d/1d/2025", "0D/0D/2026"],
            "price": ["Dddd,dd", "D.ddd,dd", "Ddd,00", "D.ddd,00", "Dddd", "Ddd"], "year": ["20dd", "201d"], "km": ["Ddd", "1ddd"], "small": ["D", "1d", "2d"],
        }
        if slot in shapes:
            return d(r.choice(shapes[slot]))
        if slot == "plate":
            letters = "".join(r.choice("ABCDEFGHJKLMNPRSTVXZ") for _ in range(3))
            p = r.choice([f"{letters}{d('dddd')}", f"{letters}-{d('dddd')}", f"{letters} {d('dddd')}", f"{letters}{d('d')}{r.choice('ABCDEFGHJ')}{d('dd')}"])
            return p if r.random() < 0.6 else p.lower()
        if slot == "city":
            return self.pick(PLACES).format(w=self.word(2, 3), g=self.first())
        if slot == "firm":
            w = self.word(3, 4)
            return r.choice([w, w, w.lower(), w.upper(), f"{w} Seguros", f"Seguradora {w}", f"Grupo {w}", f"{w} Auto", f"seguro da {w}", f"{w}!!", f"{w} (renovação)", f"cia {w} de seguros", "minha seguradora", "outra aí", "do banco"])
        if slot == "car":
            make, car = self.word(3, 4), self.word(3, 4)
            make, car = r.choice([make, make, make.lower(), make.upper()]), r.choice([car, car, car.lower(), car.upper()])
            return r.choice(["{m} {c}", "{m} {c}", "{m} {c}!!", "{m}!! {c}", "{m} {c} 1.0", "{m} {c} 2.0 aut", "{m} motors {c}", "marca {m} {c}", "{m} do Brasil {c}", "{m}/nac {c}", "{c} {m} {c} 1.6", "{m} {c} 4p", "{m} {c} sedan completo", "{m}. {c}", "é um {m} {c}", "  {m}  {c}"]).format(m=make, c=car)
        raise ValueError(slot)


def held_out(part: str) -> bool:
    return zlib.crc32(part.strip().encode()) % 5 == 0


def _clause(filler: Filler) -> str:
    """A clause with its slots still open."""
    r = filler.r
    n = r.random()
    if n < 0.32:
        slot = r.choice(list(NOUNS))
        return f"{r.choice(WHOSE)}{filler.pick(NOUNS[slot].split('|'))}{filler.pick(WHICH)}{filler.pick(JOINED)}{{{slot}}}{filler.pick(ENDED)}"
    if n < 0.37:
        return filler.pick(OFFERS)
    if n < 0.75:
        slot = r.choices(list(OPENINGS), [15, 20, 12, 8, 7, 18, 12, 20])[0]
        return f"{filler.pick(OPENINGS[slot].split('|'))}{{{slot}}}{filler.pick(CLOSINGS[slot].split('|'))}"
    if n < 0.89:
        return filler.pick(PLAIN.strip().replace("\n", "|").split("|"))
    if n < 0.94:
        return f"{r.choice(NOTED)}{filler.pick(SUBJECTS)} {filler.pick(VERBS)} {filler.pick(OBJECTS)}"
    return f"{r.choice(NOTED)}{filler.pick(ASKED)} {filler.pick(SUBJECTS)}{r.choice(['?', '', '.', ' ' + filler.pick(OBJECTS)])}"


def _pattern(filler: Filler) -> str:
    """One clause, several clauses, or bare items under each other, in any order."""
    r = filler.r
    n = r.random()
    if n < 0.68:
        text = _clause(filler)
    elif n < 0.88:
        text = r.choice([", ", ", ", " e ", ". ", "\n", " - ", "; "]).join(_clause(filler) for _ in range(r.choice([2, 2, 3])))
    else:
        slots = r.sample(list(OPENINGS), r.randint(2, 4))
        text = r.choice(["\n", "\n", ", ", " "]).join(f"{filler.pick(OPENINGS[x].split('|')) if x in LABELLED or r.random() < 0.5 else ''}{{{x}}}" for x in slots)
    return text[:1].upper() + text[1:] if r.random() < 0.4 else text


def labelled_rows(n: int, seed: int = 7, held: bool | None = None) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """`n` rows of the table: a text and its items as (start, end, kind). `held`: only from parts that are (not) held out."""
    filler = Filler(seed, held)
    r = filler.r
    rows = []
    for _ in range(n):
        text, items = "", []
        pattern = _pattern(filler)
        while pattern:
            a = pattern.find("{")
            if a < 0:
                text += pattern
                break
            b = pattern.index("}", a)
            text += pattern[:a]
            kind, _, slot = pattern[a + 1 : b].rpartition(":")
            filled = filler.fill(slot)
            if kind:
                items.append((len(text), len(text) + len(filled), kind))
            text += filled
            pattern = pattern[b + 1 :]
        typing = r.random()
        if typing < 0.18:
            text = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        elif typing < 0.23:
            text = "".join(c.upper() if len(c.upper()) == 1 else c for c in text)
        if r.random() < 0.15:
            plain = [unicodedata.normalize("NFKD", c)[0] if unicodedata.normalize("NFKD", c)[0].isalpha() else c for c in text]
            text = "".join(plain)
        rows.append((text + r.choice(TAILS), items))
    return rows
