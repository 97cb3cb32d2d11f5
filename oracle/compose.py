"""Putting the pieces of a checking query together as common table expressions."""

from __future__ import annotations

import re

from coverledger.bridge import STATEMENTS, portable_sql

WORD = re.compile(r"[a-z_0-9]+")


def compose(final: str, models: dict[str, str]) -> str:
    """``final`` with every bridge table and model it needs in front of it."""
    texts: dict[str, str] = {}
    open_names: set[str] = set()

    def visit(text: str) -> None:
        for name in WORD.findall(text):
            if name in open_names or not (name in models or name in STATEMENTS):
                continue
            open_names.add(name)
            own = models[name] if name in models else portable_sql(name)
            visit(own)
            texts[name] = own

    visit(final)
    if not texts:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in texts.items()) + "\n" + final


def finish(sql: str, decimals: str = "", doubles: str = "") -> str:
    """Common types of the compared columns: decimals with 10 places, doubles rounded to 6."""
    casts = [f"CAST({c} AS DECIMAL(38,10)) AS {c}" for c in decimals.split()]
    casts += [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in doubles.split()]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql}) finished" if casts else sql
