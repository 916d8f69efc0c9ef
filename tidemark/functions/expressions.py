"""Column expressions of parsing and validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import DQRule
from tidemark.model import OP, OPS

#: Spellings of operations, in lower case.
OP_SPELLINGS = {"load": "I", "insert": "I", "i": "I", "update": "U", "u": "U", "delete": "D", "d": "D"}


def normalise_op(raw: Column) -> Column:
    """I, U or D from any spelling; null for null and unknown ones."""
    table = F.create_map(*[F.lit(x) for pair in OP_SPELLINGS.items() for x in pair])
    return F.try_element_at(table, F.lower(F.trim(raw.cast("string"))))


def violated(rule: DQRule) -> Column:
    """Whether a row breaks a rule. Nulls break not_null alone; never null itself."""
    c = F.col(rule.column)
    broken = {
        "not_null": lambda: c.isNull(),
        "non_negative": lambda: c.try_cast("double") < 0,
        "allowed_values": lambda: ~c.cast("string").isin([str(v) for v in rule.values]),
        "valid_timestamp": lambda: c.isNotNull() & F.try_to_timestamp(c.cast("string")).isNull(),
    }[rule.kind]()
    return F.coalesce(broken, F.lit(False))


def reason(rule: DQRule) -> str:
    """The text that names a broken rule."""
    return {
        "not_null": f"{rule.column} IS NULL",
        "non_negative": f"{rule.column} < 0",
        "allowed_values": f"{rule.column} NOT IN {rule.values}",
        "valid_timestamp": f"{rule.column} is not a valid timestamp",
    }[rule.kind]


def reasons(rules: list[DQRule] | tuple[DQRule, ...]) -> Column:
    """All broken rules in order, then an invalid operation, joined by '; '; null if none."""
    named = [F.when(violated(r), F.lit(reason(r))) for r in rules]
    op = F.col(OP)
    named.append(F.when(op.isNull() | ~op.isin(*OPS), F.concat(F.lit("invalid op: "), F.coalesce(op, F.lit("<null>")))))
    found = F.array_distinct(F.array_compact(F.array(*named)))
    return F.when(F.size(found) > 0, F.array_join(found, "; "))
