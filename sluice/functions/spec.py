"""Field specs: ``Name:OP(arg)`` text compiled on the driver.

A spec list is config text such as
``Type:STRING,Amount:PRECISION(2),Day:DATE(yyyyMMdd)``.  Parsing happens once
on the driver; only the resulting column expressions reach the executors.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FieldSpec:
    """One parsed ``name:OP(arg)`` entry.

    ``problem`` is set when the spec text itself is unusable; every record that
    reaches such a field then fails with that message, as the record-level
    parse would.
    """

    name: str
    op: str
    arg: str
    problem: str | None = None


def _split_name_op(text: str) -> list[str]:
    """Cut at each ':' (with the blanks after it) unless the next parenthesis behind it closes one."""
    cuts, behind = [], ""
    for i in reversed(range(len(text))):
        if text[i] in "()":
            behind = text[i]
        elif text[i] == ":" and behind != ")":
            cuts.append(i)
    parts, start = [], 0
    for i in reversed(cuts):
        parts.append(text[start:i])
        start = len(text) - len(text[i + 1:].lstrip())
    return [*parts, text[start:]]


def _java_style_split(text: str) -> list[str]:
    parts = _split_name_op(text)
    # Java's String.split drops trailing empty strings.
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts else [""]


def op_argument(op: str) -> tuple[str, str | None]:
    """Text between the first '(' and the first ')'; '' when there is no '('.

    Returns ``(arg, problem)``; ``problem`` is set when the parentheses cannot
    be cut (no ')' or ')' before '(').
    """
    if "(" not in op:
        return "", None
    start = op.index("(") + 1
    end = op.find(")")
    if end < 0 or end < start:
        return "", f"begin {start}, end {end}, length {len(op)}"
    return op[start:end], None


def parse_field_spec(text: str) -> FieldSpec:
    """Parse one ``name:OP(arg)`` entry (exactly two parts are required)."""
    parts = _java_style_split(text)
    if len(parts) != 2:
        return FieldSpec(name=parts[0], op="", arg="", problem=f"Invalid field spec: {text}")
    name, op = parts
    arg, problem = op_argument(op)
    return FieldSpec(name=name, op=op, arg=arg, problem=problem)


def parse_operation(op: str) -> FieldSpec:
    """An operation without a field name, as used by update rules."""
    arg, problem = op_argument(op)
    return FieldSpec(name="", op=op, arg=arg, problem=problem)


def split_header_list(text: str) -> list[str]:
    """Split a header list on commas outside parentheses and trim each entry.

    Plain comma splitting would break a date pattern that contains a comma,
    so the split skips commas nested in ``(...)``.
    """
    out: list[str] = []
    depth = 0
    cur: list[str] = []
    for ch in text:
        if ch == "(":
            depth += 1
        elif ch == ")" and depth > 0:
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur).strip())
    return out


def parse_header_list(text: str) -> list[FieldSpec]:
    return [parse_field_spec(item) for item in split_header_list(text)]
