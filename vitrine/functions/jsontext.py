"""JSON text as variants, by one rule for repeated keys in any session."""

from __future__ import annotations

from vitrine.functions.nodes import fresh, let


def parsed_json(source: str) -> str:
    """SQL: the variant of a JSON text; null if it is no JSON.

    Of a key that an object repeats, the last value holds.  The session option
    for that (``spark.sql.variant.allowDuplicateKeys``) is not needed: an object
    that the parser refuses is read as entries, and the last of each key makes
    the object.  Objects inside other values that repeat a key are only read
    where the session allows them.
    """
    e, i, kept = fresh(), fresh(), fresh()

    def last_of_each(entries: str) -> str:
        ordered = f"array_sort(transform({entries}, ({e}, {i}) -> named_struct('key', {e}.key, 'at', {i})))"
        return let(ordered, lambda o: (
            f"to_variant_object(map_from_entries(transform("
            f"filter({o}, ({e}, {i}) -> {i} = size({o}) - 1 OR get({o}, {i} + 1).key <> {e}.key),"
            f" {kept} -> named_struct('key', {kept}.key, 'value', get({entries}, {kept}.at).value))))"))

    return (f"coalesce(try_parse_json({source}),"
            f" {let(f'map_entries(from_json({source}, {chr(39)}map<string,variant>{chr(39)}))', last_of_each)})")
