"""Input schemas and the question catalogue of the survey extracts.

Extract files (``;``-separated, Latin-1, header) and registries are read by
column *name*; the types are ours (ids stay ``bigint`` even where the
source has gaps).
"""

from __future__ import annotations

import string
from dataclasses import dataclass

EDITION = "edition"
COURSE = "CO_CURSO"
INSTITUTION = "CO_IES"
COUNTED = "NU_ANO"              # answers count non-missing values of this column
SCORE_COLS = ("NT_GER", "NT_FG", "NT_CE")
AGE_COL = "NU_IDADE"
AGE_STATS = ("MEDIA_IDADE", "MEDIANA_IDADE", "DESVIO_PADRAO_IDADE")
MISSING = "N"

# Column names and types of the extracts and registries.
SCORES = [(COURSE, "bigint"), ("NT_GER", "double"), ("NT_FG", "double"), ("NT_CE", "double")]
AGES = [(COURSE, "bigint"), (AGE_COL, "int")]

COURSE_REGISTRY = [
    ("NU_ANO_CENSO", "int"), ("NO_REGIAO", "string"), ("CO_REGIAO", "int"),
    ("NO_UF", "string"), ("SG_UF", "string"), ("CO_UF", "int"),
    ("NO_MUNICIPIO", "string"), ("CO_MUNICIPIO", "bigint"), ("IN_CAPITAL", "int"),
    ("TP_DIMENSAO", "int"), ("TP_ORGANIZACAO_ACADEMICA", "int"),
    ("TP_CATEGORIA_ADMINISTRATIVA", "int"), ("TP_REDE", "int"), (INSTITUTION, "bigint"),
    ("NO_CURSO", "string"), (COURSE, "bigint"), ("NO_CINE_ROTULO", "string"),
    ("CO_CINE_ROTULO", "string"), ("CO_CINE_AREA_GERAL", "int"), ("NO_CINE_AREA_GERAL", "string"),
]

INSTITUTION_REGISTRY = [
    ("NU_ANO_CENSO", "int"), ("NO_REGIAO_IES", "string"), ("CO_REGIAO_IES", "int"),
    ("NO_UF_IES", "string"), ("SG_UF_IES", "string"), ("CO_UF_IES", "int"),
    ("NO_MUNICIPIO_IES", "string"), ("CO_MUNICIPIO_IES", "bigint"), ("IN_CAPITAL_IES", "int"),
    ("TP_ORGANIZACAO_ACADEMICA", "int"), ("TP_CATEGORIA_ADMINISTRATIVA", "int"),
    ("NO_MANTENEDORA", "string"), ("CO_MANTENEDORA", "bigint"), (INSTITUTION, "bigint"),
    ("NO_IES", "string"), ("SG_IES", "string"),
]


@dataclass(frozen=True)
class Question:
    """One questionnaire item: its extract file, its column, the answer codes
    in output order (last = not answered) and one display label per code."""

    name: str
    file_no: int
    column: str
    codes: tuple[str, ...]
    labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.codes) != len(self.labels):
            raise ValueError(f"{self.name}: {len(self.codes)} codes, {len(self.labels)} labels")

    def cell(self, code: str) -> str:
        """Internal column id of one (question, code) cell."""
        return f"{self.name}__{code}"

    def cells(self) -> list[tuple[str, str, str]]:
        return [(self.name, c, self.cell(c)) for c in self.codes]

    def schema(self) -> list[tuple[str, str]]:
        return [(COUNTED, "int"), (COURSE, "bigint"), (self.column, "string")]


def letter_codes(k: int) -> tuple[str, ...]:
    """Answer codes of a k-option item: the first k letters, then the
    not-answered code (sorts last while k <= 13)."""
    return tuple(string.ascii_uppercase[:k]) + (MISSING,)


# Display labels of every questionnaire item, in answer-code
# order; the last label of each item is its "not answered" column.
_LABELS = {
    "marital_status": (
        "SOLTEIRO", "CASADO", "SEPARADO JUDICIALMENTE/DIVORCIADO", "VIÚVO", "OUTRO",
        "INFO_ESTADO_CIVIL_NÃO RESPONDEU"),
    "colour_race": (
        "BRANCA", "PRETA", "AMARELA", "PARDA", "INDÍGINA", "NÃO QUERO DECLARAR",
        "INFO_COR_NÃO RESPONDEU"),
    "housing": (
        "Em casa ou apartamento, sozinho.",
        "Em casa ou apartamento, com pais e/ou parentes.",
        "Em casa ou apartamento, com cônjuge e/ou filhos.",
        "Em casa ou apartamento, com outras pessoas (incluindo república).",
        "Em alojamento universitário da própria instituição.",
        "Em outros tipos de habitação individual ou coletiva (hotel, hospedaria, pensão ou outro).",
        "INFO_RESIDENCIA_NÃO RESPONDEU"),
    "household_size": (
        "Nenhuma", "Uma", "Duas", "Três", "Quatro", "Cinco", "Seis", "Sete ou mais",
        "INFO_QUANTIDADE_RESIDENCIA_NÃO RESPONDEU"),
    "family_income": (
        "Até 1,5 salário mínimo (até R$ 1.650,00)",
        "De 1,5 a 3 salários mínimos (R$ 1.650,01 a R$ 3.300,00)",
        "De 3 a 4,5 salários mínimos (R$ 3.300,01 a R$ 4.950,00)",
        "De 4,5 a 6 salários mínimos (R$ 4.950,01 a R$ 6.600,00)",
        "De 6 a 10 salários mínimos (R$ 6.600,01 a R$ 11.000,00)",
        "De 10 a 30 salários mínimos (R$ 11.000,01 a R$ 33.000,00)",
        "Acima de 30 salários mínimos (mais de R$ 33.000,00)",
        "INFO_RENDA_NÃO RESPONDEU"),
    "own_finances": (
        "Não tenho renda e meus gastos são financiados por programas governamentais",
        "Não tenho renda e meus gastos são financiados pela minha família ou por outras pessoas",
        "Tenho renda, mas recebo ajuda da família ou de outras pessoas para financiar meus gastos",
        "Tenho renda e não preciso de ajuda para financiar meus gastos",
        "Tenho renda e contribuo com o sustento da família",
        "Sou o principal responsável pelo sustento da família",
        "INFO_FINANCEIRO_NÃO RESPONDEU"),
    "work_hours": (
        "Não estou trabalhando", "Trabalho eventualmente", "Trabalho até 20 horas semanais",
        "Trabalho de 21 a 39 horas semanais", "Trabalho 40 horas semanais ou mais",
        "INFO_TRABALHO_NÃO RESPONDEU"),
    "tuition_funding": (
        "Nenhum, pois meu curso é gratuito", "Nenhum, embora meu curso não seja gratuito",
        "ProUni Integral", "ProUni parcial, apenas", "FIES, apenas", "ProUni Parcial e FIES",
        "Bolsa oferecida por governo estadual, distrital ou municipal",
        "Bolsa oferecida pela própria instituição",
        "Bolsa oferecida por outra entidade (empresa, ONG, outra)",
        "Financiamento oferecido pela própria instituição", "Financiamento bancário",
        "INFO_FINANCIAMENTO_NÃO RESPONDEU"),
    "permanence_aid": (
        "Nenhum", "Auxílio moradia", "Auxílio alimentação", "Auxílio moradia e alimentação",
        "Auxílio Permanência", "Outro tipo de auxílio", "INFO_AUXILIO_NÃO RESPONDEU"),
    "scholarship": (
        "Nenhum", "Bolsa de iniciação científica", "Bolsa de extensão",
        "Bolsa de monitoria/tutoria", "Bolsa PET", "Outro tipo de bolsa acadêmica",
        "INFO_BOLSA_NÃO RESPONDEU"),
    "exchange_abroad": (
        "Não participei", "Sim, Programa Ciência sem Fronteiras",
        "Sim, programa de intercâmbio financiado pelo Governo Federal (Marca; Brafitec; PLI; outro)",
        "Sim, programa de intercâmbio financiado pelo Governo Estadual",
        "Sim, programa de intercâmbio da minha instituição",
        "Sim, outro intercâmbio não institucional", "INFO_EXTERIOR_NÃO RESPONDEU"),
    "affirmative_policy": (
        "Não", "Por critério étnico-racial", "Por critério de renda",
        "Por ter estudado em escola pública ou particular com bolsa de estudos",
        "Por sistema que combina dois ou mais critérios anteriores",
        "Por sistema diferente dos anteriores", "INFO_POLITICA AFIRMATIVA_NÃO RESPONDEU"),
    "study_hours": (
        "Nenhuma, apenas assisto às aulas", "De uma a três", "De quatro a sete",
        "De oito a doze", "Mais de doze", "INFO_HORAS_ESTUDO_NÃO RESPONDEU"),
}

# Fixed values: (item, extract file number, source column), in mart order.
_ITEMS = (
    ("marital_status", 7, "QE_I01"), ("colour_race", 8, "QE_I02"), ("housing", 12, "QE_I06"),
    ("household_size", 13, "QE_I07"), ("family_income", 14, "QE_I08"),
    ("own_finances", 15, "QE_I09"), ("work_hours", 16, "QE_I10"),
    ("tuition_funding", 17, "QE_I11"), ("permanence_aid", 18, "QE_I12"),
    ("scholarship", 19, "QE_I13"), ("exchange_abroad", 20, "QE_I14"),
    ("affirmative_policy", 21, "QE_I15"), ("study_hours", 29, "QE_I23"),
)

# Sex keeps its raw codes as labels, in the output order M, F, N.
SEX = Question("sex", 5, "TP_SEXO", ("M", "F", MISSING), ("M", "F", MISSING))

QUESTIONS: tuple[Question, ...] = (SEX,) + tuple(
    Question(name, file_no, column, letter_codes(len(_LABELS[name]) - 1), _LABELS[name])
    for name, file_no, column in _ITEMS)

SCORES_FILE_NO = 3
AGES_FILE_NO = 6


def all_cells(questions=QUESTIONS) -> list[tuple[str, str, str]]:
    return [c for q in questions for c in q.cells()]


def item_id(q: Question, questions=QUESTIONS) -> int:
    """Small integer id of an item: its position in the catalogue."""
    return list(questions).index(q)


def item_cells(questions=QUESTIONS) -> list[tuple[int, str, str]]:
    """(item id, code, cell id) of every mart count column."""
    return [(i, code, q.cell(code)) for i, q in enumerate(questions) for code in q.codes]


def display_names(questions=QUESTIONS) -> dict[str, str]:
    """Internal cell id -> sink column name. A label used by two items (e.g.
    "Nenhum") gets its source column appended, so both survive (the original
    dropped both copies from the institution mart)."""
    seen: dict[str, int] = {}
    for q in questions:
        for lab in q.labels:
            seen[lab] = seen.get(lab, 0) + 1
    out = {}
    for q in questions:
        for code, lab in zip(q.codes, q.labels):
            out[q.cell(code)] = f"{lab} [{q.column}]" if seen[lab] > 1 else lab
    return out
