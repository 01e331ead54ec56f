"""SQL expressions over arrays of structs inside one document.

A document with several independent arrays, flattened side by side, yields the
cross product of all of them, and MAX / distinct aggregation then folds it back
to one row. Both aggregates ignore duplicates, so each array (a *branch*) can be
folded on its own inside the row: no product, no shuffle, same result. A missing
or empty array contributes one NULL element, as an outer flatten would.

The helpers return SQL text: a resource has dozens of such columns, and text
costs one call into the JVM per column. Lambda variables are named by the
caller; `e` is the element of a folded branch.
"""

from __future__ import annotations


def quoted(value: str | None) -> str:
    """A SQL string literal, or NULL."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def tail(text: str, separator: str = "/") -> str:
    """Last piece of a text delimited by one character; the others are not cut out."""
    return f"substring_index({text}, {quoted(separator)}, -1)"


def elements(array: str) -> str:
    """The array, or a single NULL element where it is missing or empty."""
    return f"if(size({array}) > 0, {array}, array(get({array}, 0)))"


def mapped(array: str, var: str, value: str) -> str:
    """`value` per element, outer."""
    return f"transform({elements(array)}, {var} -> {value})"


def pairs(array: str, outer: str, child: str, inner: str, value: str) -> str:
    """`value` per (element, element of its child array), outer on both levels."""
    return f"flatten({mapped(array, outer, mapped(child, inner, value))})"


def packed(**fields: str) -> str:
    """A struct of named expressions."""
    return "named_struct(" + ", ".join(f"'{n}', {x}" for n, x in fields.items()) + ")"


def best(branch: str, value: str) -> str:
    """MAX of an unconditional value over the branch."""
    return f"array_max(transform({branch}, e -> {value}))"


def tagged_values(branch: str, match: str, value: str, default: str | None = None) -> str:
    """`value` of matching elements, the default for the others, as an array."""
    return f"transform({branch}, e -> if({match}, {value}, {quoted(default)}))"


def tagged(branch: str, match: str, value: str, default: str | None = None) -> str:
    """MAX of `tagged_values`. A lone match whose value is missing stays NULL."""
    return f"array_max({tagged_values(branch, match, value, default)})"


def entry(pairs: str, key: str) -> str:
    """Value of a key of a map of texts; the last one where a JSON object names it twice, as a struct has it."""
    at = f"array_position(reverse(map_keys({pairs})), {quoted(key)})"
    return f"get(reverse(map_values({pairs})), cast({at} as int) - 1)"


def looked_up(array: str, keys: str, key: str, key_of, value, others: str) -> str:
    """MAX of `value` over the elements whose key is `key`, '' for the others, as `tagged` gives it over every element.

    `keys` are the keys of the elements in their order, `key_of` and `value` give the expressions of one
    element, `others` tells whether an element of another key stands outside the array. Keys seldom
    repeat, so the element is found by its place and its value read alone; only where the key occurs
    again are all elements gone through. '' is the least text: it counts where nothing else is found.
    """
    place, again = f"array_position({keys}, {quoted(key)})", f"array_position(reverse({keys}), {quoted(key)})"
    same = f"filter({array}, e -> {key_of('e')} = {quoted(key)})"
    lone = f"coalesce({value(f'get({array}, cast({place} as int) - 1)')}, if(size({keys}) > 1 or {others}, '', null))"
    many = f"coalesce(array_max(transform({same}, e -> {value('e')})), if(size({keys}) > size({same}) or {others}, '', null))"
    return f"case when coalesce({place}, 0) = 0 then '' when {place} + {again} = size({keys}) + 1 then {lone} else {many} end"


def one_of(text: str, values) -> str:
    return f"{text} in ({', '.join(quoted(v) for v in values)})"


def joined_set(array: str, separator: str) -> str:
    """Distinct non-NULL elements, sorted, joined; nothing gives `''`."""
    return f"array_join(sort_array(array_distinct(array_compact({array}))), {quoted(separator)})"


def squeeze(text: str) -> str:
    """Runs of blanks become one blank."""
    return f"regexp_replace({text}, ' +', ' ')"


def strip_blanks(text: str) -> str:
    """Removes every blank."""
    return f"replace({text}, ' ', '')"


def concatenated(*parts: str) -> str:
    """Concatenation that is NULL as soon as one part is."""
    return f"concat({', '.join(parts)})"
