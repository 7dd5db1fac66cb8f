"""Prefix a statement with the common table expressions it names."""

from __future__ import annotations

import re

from oracles.domain import DOMAIN


def _names(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql)) if w in DOMAIN]


def compose(body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _names(DOMAIN[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for name in _names(body):
        visit(name)
    ctes = [f"{n} AS ({DOMAIN[n].strip()})" for n in order]
    body = body.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    if recursive:
        body = body[len("WITH RECURSIVE"):].strip()
    elif body.upper().startswith("WITH "):
        body = body[len("WITH "):].strip()
    elif ctes:
        return "WITH " + ",\n".join(ctes) + "\n" + body
    else:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join([*ctes, body])
