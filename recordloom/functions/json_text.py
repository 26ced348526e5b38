"""JSON expressions: strict whole-text parsing, canonical text and content hash.

All functions take and return SQL text, for ``F.expr`` and ``selectExpr``.
"""

from __future__ import annotations

from collections.abc import Mapping

from recordloom.functions.sql import quoted


def field_path(name: str) -> str:
    """JSONPath of a top-level field, safe for names with dots or spaces."""
    escaped = name.replace("\\", "\\\\").replace('"', '\\"')
    return f'$["{escaped}"]'


def variant_field(value: str, name: str, type_name: str = "variant") -> str:
    """Field of a variant object; NULL if it is missing or cannot be converted."""
    return f"try_variant_get({value}, {quoted(field_path(name))}, {quoted(type_name)})"


def parse_json_strict(text: str) -> str:
    """Variant of a text that is exactly one JSON value, else NULL.

    ``try_parse_json`` ignores whatever follows the first value. The text is therefore put into an
    array in front of its own hash: it is one whole value if and only if the hash is found in the
    second place and nothing follows, and one parse settles both value and completeness.
    """
    mark = f"xxhash64({text})"
    parsed = f"try_parse_json(concat('[', {text}, ',', cast({mark} as string), ']'))"
    return (
        f"CASE WHEN try_variant_get({parsed}, '$[1]', 'bigint') = {mark} "
        f"AND try_variant_get({parsed}, '$[2]', 'variant') IS NULL "
        f"THEN try_variant_get({parsed}, '$[0]', 'variant') END"
    )


def opening_kind(text: str) -> str:
    """``object``, ``array`` or ``scalar``, told from the first character of a stripped JSON text.

    Cheaper than :func:`json_kind`, which looks at every part of a nested value.
    """
    return f"CASE left({text}, 1) WHEN '{{' THEN 'object' WHEN '[' THEN 'array' ELSE 'scalar' END"


def json_kind(value: str) -> str:
    """``object``, ``array``, ``string``, ``integer``, ``float``, ``boolean``, ``null``; NULL for a missing value.

    Integers outside 64 bits count as ``float``.
    """
    shape = f"schema_of_variant({value})"
    return (
        f"CASE WHEN {shape} = 'STRING' THEN 'string' WHEN {shape} = 'BIGINT' THEN 'integer' "
        f"WHEN startswith({shape}, 'DECIMAL') OR {shape} IN ('DOUBLE', 'FLOAT') THEN 'float' "
        f"WHEN {shape} = 'BOOLEAN' THEN 'boolean' WHEN {shape} = 'VOID' THEN 'null' "
        f"WHEN startswith({shape}, 'OBJECT') THEN 'object' WHEN startswith({shape}, 'ARRAY') THEN 'array' END"
    )


def _float_text(value: str) -> str:
    """Shortest text of a double with the exponent rules of Python's ``repr``.

    Java switches to exponents below 1e-3 and from 1e7 on, Python below 1e-4 and from 1e16 on. Before
    version 19, Java writes a few doubles with one digit more than needed, and so does this.
    """
    java = f"cast({value} as string)"
    mantissa = f"regexp_replace(substring_index({java}, 'E', 1), '^-|[.]0$|[.]', '')"
    exponent = f"cast(substring_index({java}, 'E', -1) as int)"
    digits = f"length({mantissa})"
    small = f"concat('0.', repeat('0', -{exponent} - 1), {mantissa})"
    large = (
        f"CASE WHEN {digits} <= {exponent} + 1 THEN concat({mantissa}, repeat('0', {exponent} + 1 - {digits}), '.0') "
        f"ELSE concat(left({mantissa}, {exponent} + 1), '.', substring({mantissa}, {exponent} + 2)) END"
    )
    scientific = (
        f"concat(left({mantissa}, 1), CASE WHEN {digits} > 1 THEN concat('.', substring({mantissa}, 2)) ELSE '' END, "
        f"CASE WHEN {exponent} < 0 THEN 'e-' ELSE 'e+' END, "
        f"lpad(cast(abs({exponent}) as string), greatest(2, length(cast(abs({exponent}) as string))), '0'))"
    )
    return (
        f"CASE WHEN contains({java}, 'E') THEN concat(CASE WHEN startswith({java}, '-') THEN '-' ELSE '' END, "
        f"CASE WHEN {exponent} < 0 AND {exponent} >= -4 THEN {small} "
        f"WHEN {exponent} >= 0 AND {exponent} < 16 THEN {large} ELSE {scientific} END) ELSE {java} END"
    )


def _lower_escapes(json_text: str) -> str:
    """JSON text whose ``\\u00XX`` escapes carry lower-case digits."""
    lowered = json_text
    for digit in "ABCDEF":
        pattern = rf"(?<!\\)((?:\\\\)*\\u00[01]){digit}"
        lowered = f"regexp_replace({lowered}, {quoted(pattern)}, {quoted(f'$1{digit.lower()}')})"
    escape, any_upper = quoted("\\u00"), quoted(r"\\u00[01][A-F]")
    return (
        f"CASE WHEN contains({json_text}, {escape}) AND {json_text} RLIKE {any_upper} THEN {lowered} ELSE {json_text} END"
    )


def _object_text(columns: Mapping[str, tuple[str, str]]) -> str:
    """Compact JSON object of columns other than floats, nulls kept."""
    parts = ", ".join(f"{quoted(key)}, {value}" for key, (value, _) in columns.items())
    return _lower_escapes(f"to_json(named_struct({parts}), map('ignoreNullFields', 'false'))")


def _value_text(value: str, type_name: str) -> str:
    """JSON text of a typed column; ``null`` for NULL."""
    if type_name == "string":
        wrapped = f"to_json(named_struct('v', {value}))"
        text = _lower_escapes(f"substring({wrapped}, 6, length({wrapped}) - 6)")
    elif type_name == "float":
        text = _float_text(value)
    else:
        text = f"cast({value} as string)"
    return f"coalesce({text}, 'null')"


def _key_text(key: str) -> str:
    return _value_text(quoted(key), "string")


def indented_json(columns: Mapping[str, tuple[str, str]]) -> str:
    """JSON object in the given key order, one key per line, indented by two spaces."""
    if not columns:
        return "'{}'"
    lines = ", ".join(
        f"concat('  ', {_key_text(key)}, ': ', {_value_text(value, type_name)})"
        for key, (value, type_name) in columns.items()
    )
    return f"concat('{{\\n', concat_ws(',\\n', {lines}), '\\n}}')"


def canonical_json(columns: Mapping[str, tuple[str, str]]) -> str:
    """Compact JSON object with sorted keys; nulls and non-ASCII characters are kept.

    ``columns`` maps each key to its column (SQL text) and its type (string, integer, float, boolean).
    """
    if not columns:
        return "'{}'"
    ordered = {key: columns[key] for key in sorted(columns)}
    if all(type_name != "float" for _, type_name in ordered.values()):
        return _object_text(ordered)
    pieces = ", ".join(
        f"concat({_key_text(key)}, ':', {_value_text(value, type_name)})" for key, (value, type_name) in ordered.items()
    )
    return f"concat('{{', concat_ws(',', {pieces}), '}}')"


def item_hash(columns: Mapping[str, tuple[str, str]]) -> str:
    """MD5 hex of :func:`canonical_json`: equal for items with equal fields, whatever their order."""
    return f"md5({canonical_json(columns)})"
