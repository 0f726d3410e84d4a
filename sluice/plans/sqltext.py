"""SQL text for the oracle."""

from __future__ import annotations


def decimal_rounds(sql: str) -> str:
    """round(x, n) becomes half-up rounding of the decimal value that x stands for, as operators.aggregates.rounded does."""
    out, i = [], 0
    while (at := sql.find("round(", i)) >= 0:
        depth, j, comma = 1, at + 6, -1
        while depth:
            c = sql[j]
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 1:
                comma = j
            j += 1
        inner = decimal_rounds(sql[at + 6 : comma])
        out += [sql[i:at], f"CAST(round(CAST({inner} AS DECIMAL(24,6)),{sql[comma + 1 : j - 1]}) AS DOUBLE)"]
        i = j
    return "".join([*out, sql[i:]])
