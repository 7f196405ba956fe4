"""Edits of JSON text that leave all the rest as it stands, character by character.

Parsing a document and writing it again rounds long numbers, turns ``1.0`` into ``1`` and loses key order and white
space.  Here the places of an object's members are found in the text, and members are cut out or replaced there.
"""

from __future__ import annotations

import json
import sys
from json.decoder import scanstring
from typing import NamedTuple

# The functions run in Python workers: pickled by value, so that a worker needs no package on its path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # older cloudpickle: the package must then be on the workers' path
    pass


class Member(NamedTuple):
    key: str
    start: int  # of the key's quote
    value: int
    end: int


def _refuse(name: str):
    raise ValueError(name)


class _Decoder(json.JSONDecoder):
    """Finds where values end; numbers are never converted.  Made once in each process (its scanner can't be pickled)."""

    def __init__(self):
        json.JSONDecoder.__init__(self, parse_int=len, parse_float=len, parse_constant=_refuse)

    def __reduce__(self):
        return _Decoder, ()


_DECODER = _Decoder()


def _value_end(text: str, at: int) -> int:
    """End of the value that begins at ``at``."""
    return _DECODER.raw_decode(text, at)[1]


def skip(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t\n\r":
        at += 1
    return at


def members(text: str, at: int) -> tuple[list[Member], int]:
    """Members of the object at ``at``, repeated keys included, and the place behind it; ValueError if it isn't one."""
    out: list[Member] = []
    if text[at:at + 1] != "{":
        raise ValueError("not an object")
    at = skip(text, at + 1)
    if text[at:at + 1] == "}":
        return out, at + 1
    while True:
        if text[at:at + 1] != '"':
            raise ValueError("no key")
        key, colon = scanstring(text, at + 1)
        colon = skip(text, colon)
        if text[colon:colon + 1] != ":":
            raise ValueError("no colon")
        value = skip(text, colon + 1)
        end = _value_end(text, value)
        out.append(Member(key, at, value, end))
        at = skip(text, end)
        if text[at:at + 1] == "}":
            return out, at + 1
        if text[at:at + 1] != ",":
            raise ValueError("no comma")
        at = skip(text, at + 1)


def document(text: str) -> list[Member]:
    """Members of a text that is one object."""
    found, end = members(text, skip(text, 0))
    if skip(text, end) != len(text):
        raise ValueError("text behind the object")
    return found


def cuts(of: list[Member], kept: list[Member]) -> list[tuple[int, int, str]]:
    """Edits that cut out all members but the kept ones, each with one comma; without any, the object is left empty."""
    if not of or len(kept) == len(of):
        return []
    if not kept:
        return [(of[0].start, of[-1].end, "")]
    after = {m.start: of[k + 1] for k, m in enumerate(of[:-1])}
    out = [(of[0].start, kept[0].start, "")]
    out += [(after[m.start].start, n.start, "") for m, n in zip(kept, kept[1:])]
    return [*out, (kept[-1].end, of[-1].end, "")]


def edited(text: str, start: int, stop: int, edits: list[tuple[int, int, str]]) -> str:
    """The text from ``start`` to ``stop`` with disjoint (start, end, replacement) edits."""
    out, at = [], start
    for a, b, new in sorted(edits):
        if start <= a and b <= stop:
            out += [text[at:a], new]
            at = b
    return "".join([*out, text[at:stop]])


def last(of: list[Member], key: str) -> Member | None:
    """The member that counts: of repeated keys the last one."""
    return next((m for m in reversed(of) if m.key == key), None)


def without(text: str | None, keys: tuple[str, ...]) -> str | None:
    """The object's text without these members; None where the text is not one object."""
    try:
        found = document(text or "")
    except (ValueError, RecursionError):
        return None
    return edited(text, 0, len(text), cuts(found, [m for m in found if m.key not in keys]))


# Fixed values that must equal the source tool's: the reason of a version that its metadata lacks.
MISSING = "missing_from_metadata"


def publish_parts(text: str | None, version: str | None, tarball: str | None) -> tuple[str | None, str | None, str | None, str | None, str | None]:
    """An npm metadata document made ready to publish one version.

    (body, close, versions, spec, reason): the document without ``_rev`` and ``_attachments``, with this version only
    and its ``dist.tarball`` set, in two parts between which attachments go; the text of the one-version object; that
    of the version itself; or else a reason: ``no_metadata`` (null or blank), ``invalid_json`` (not one object),
    ``missing_from_metadata`` (no such version, or an empty one), ``no_dist``.
    """
    refused = (None, None, None, None)
    if text is None or not text.strip():
        return *refused, "no_metadata"
    try:
        top = document(text)
        versions = last(top, "versions")
        listed = members(text, versions.value)[0] if versions and text[versions.value] == "{" else []
        spec = last(listed, version)
        fields = members(text, spec.value)[0] if spec and text[spec.value] == "{" else []
        if not fields:
            return *refused, MISSING
        dist = last(fields, "dist")
        if not dist or text[dist.value] != "{":
            return *refused, "no_dist"
        inside, dist_end = members(text, dist.value)
    except (ValueError, RecursionError):
        return *refused, "invalid_json"
    address, old = json.dumps(tarball, ensure_ascii=False), last(inside, "tarball")
    within = cuts(fields, [m for m in fields if m.key != "dist" or m == dist])
    if old:
        within += [*cuts(inside, [m for m in inside if m.key != "tarball" or m == old]), (old.value, old.end, address)]
    else:
        within.append((dist_end - 1, dist_end - 1, (", " if inside else "") + '"tarball": ' + address))
    one = cuts(listed, [spec])
    kept = [m for m in top if m == versions or m.key not in ("_rev", "_attachments", "versions")]
    body = edited(text, 0, kept[-1].end, cuts(top, kept) + one + within)
    return (body, text[top[-1].end:], edited(text, versions.value, versions.end, one), edited(text, spec.value, spec.end, within), None)
