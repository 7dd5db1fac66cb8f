"""Independent SQL statements that state what each registered query must return."""

from oracles.compose import compose
from oracles.models import MODEL_SQL
from oracles.operators import OPERATOR_SQL


def all_sql() -> dict[str, str]:
    return {name: compose(body) for name, body in {**MODEL_SQL, **OPERATOR_SQL}.items()}


__all__ = ["all_sql", "compose"]
