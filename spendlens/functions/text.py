"""Text rules and labels as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

Rules = dict[str, list[str]]

# Category names and their keywords, in matching order.
EXPENSE_RULES: Rules = {
    "Transporte": [
        "bilhete", "passagem", "locomoção", "locomocao", "transporte",
        "aluguel de veículos", "aluguel de veiculos",
        "combustível", "combustivel", "taxi", "uber", "veículo", "veiculo", "fretamento",
    ],
    "Alimentação": [
        "alimentação", "alimentacao", "restaurante", "refeição", "refeicao", "lanches",
    ],
    "Escritório e Funcionamento": [
        "escritório", "escritorio", "materiais", "serviços postais", "servicos postais",
        "correios", "telefone", "internet", "locação", "locacao", "espaço", "espaco",
        "condomínio", "condominio", "copiadora", "material de expediente",
    ],
    "Cursos e Capacitação": [
        "curso", "capacitação", "capacitacao", "treinamento", "inscrição", "inscricao",
    ],
    "Divulgação do Mandato": [
        "publicidade", "divulgação", "divulgacao", "assessoria de imprensa", "marketing",
    ],
}
DEFAULT_CATEGORY = "Outros"
UNKNOWN = "Desconhecido"

# Letters a slug replaces, and their replacements, position by position.
SLUG_FROM = "áàãâéêíóôõúç-/ "
SLUG_TO = "aaaaeeiooouc___"


def classify_text(col: Column, rules: Rules = EXPENSE_RULES, default: str = DEFAULT_CATEGORY) -> Column:
    """First category with a keyword inside the lower-cased text (plain substring, accents kept)."""
    text = F.lower(col)
    out = None
    for category, words in rules.items():
        hit = reduce(lambda a, b: a | b, [text.contains(word) for word in words])
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def categories_of(rules: Rules = EXPENSE_RULES, default: str = DEFAULT_CATEGORY) -> list[str]:
    """The closed category list: every rule, then the default."""
    return [*rules, default]


def slug(col: Column) -> Column:
    return F.translate(F.lower(col), SLUG_FROM, SLUG_TO)


def slug_name(name: str) -> str:
    """``slug`` for a Python string, used to name columns at plan time."""
    return name.lower().translate(str.maketrans(SLUG_FROM, SLUG_TO))


def category_column(category: str) -> str:
    return f"spend_{slug_name(category)}"


def fill_unknown(col: Column, label: str = UNKNOWN) -> Column:
    return F.coalesce(col, F.lit(label))


def label_entity(name: Column, grp: Column) -> Column:
    return F.concat(name, F.lit(" ("), grp, F.lit(")"))
