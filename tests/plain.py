"""What a response comes to, in plain Python, for comparison on small inputs."""

import hashlib
import json

PY_TYPES = {"string": str, "integer": int, "float": float, "boolean": bool}


def parse(text):
    body = text.strip()
    if body.startswith("```json") and body.endswith("```"):
        body = body[7:-3].strip()
    elif body.startswith("```") and body.endswith("```"):
        body = body[3:-3].strip()
    try:
        value = json.loads(body)
    except ValueError:
        return "PARSE_ERROR", None
    if isinstance(value, dict):
        value = [value]
    return ("PARSED", value) if isinstance(value, list) else ("NOT_A_LIST", None)


def check(item, fields, constraints):
    """The record an item becomes, or None."""
    if not isinstance(item, dict):
        return None
    record = {}
    for name, type_name, required in fields:
        value = item.get(name)
        if value is None:
            if required:
                return None
            record[name] = None
            continue
        kind = PY_TYPES[type_name]
        if kind is float and isinstance(value, int):
            value = float(value)
        if not isinstance(value, kind):
            return None
        if kind is int:
            value = int(value)
        if name in constraints and not constraints[name](value):
            return None
        record[name] = value
    return record


def content_hash(record):
    return hashlib.md5(
        json.dumps(record, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()
    ).hexdigest()
