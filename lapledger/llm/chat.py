"""Chat formatting: records of many layouts become canonical turns, and turns become marked text.

A record is a JSON object. The paths of its nested fields (``messages[].role``) are sorted and hashed; the hash
selects a declared mapping that says where turns, roles and texts are. A record with fields that no mapping
knows falls back to the mapping with the most paths among those whose paths it has all of.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


class Mapping(NamedTuple):
    """Either a list of messages with a role and a text each, or single fields that are a turn each."""

    name: str
    messages: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()  # (role, field) in the order of turns
    optional: tuple[str, ...] = ()  # paths that may be absent; a turn whose field is absent is left out
    order: str = ""  # a field of the record that places its turn among the conversation's


MAPPINGS = (
    Mapping("turn", role="role", text="text", order="turn", optional=("turn",)),
    Mapping("messages", "messages", "role", "content"),
    Mapping("messages with name", "messages", "role", "content", optional=("messages[].name",)),
    Mapping("message parts", "messages", "role", "content[].text", optional=("messages[].content[].type",)),
    Mapping("turns", "turns", "role", "text", optional=("turns[].turn",)),
    Mapping("from and value", "conversations", "from", "value", fields=(("system", "system"),), optional=("system", "id")),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Mapping("prompt and completion", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
)
ROLES = {"human": "user", "gpt": "assistant"}


def paths_of(value, prefix: str = "") -> set[str]:
    """The paths of all leaves; a list adds ``[]`` to its path, and an empty one is a leaf."""
    if isinstance(value, dict) and value:
        return {p for k, v in value.items() for p in paths_of(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, f"{prefix}[]")} or {f"{prefix}[]"}
    return {prefix}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def all_paths(mapping: Mapping) -> set[str]:
    within = f"{mapping.messages}[]." if mapping.messages else ""
    own = {within + x for x in (mapping.role, mapping.text) if x} | {f for _, f in mapping.fields} | set(mapping.optional)
    return own | ({mapping.order} if mapping.order else set())


def registry(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    """Mappings by fingerprint, one for each choice of a mapping's optional paths."""
    known: dict[str, Mapping] = {}
    for mapping in mappings:
        every, free = all_paths(mapping), mapping.optional
        for n in range(len(free) + 1):
            for absent in combinations(free, n):
                known.setdefault(fingerprint(every - set(absent)), mapping)
    return known


def select(record, known: dict[str, Mapping]) -> tuple[str, Mapping | None]:
    paths = paths_of(record) if isinstance(record, dict) else set()
    mark = fingerprint(paths)
    if mark in known:
        return mark, known[mark]
    fits = [
        (len(needed), mapping)
        for mapping in dict.fromkeys(known.values())
        if (needed := all_paths(mapping) - set(mapping.optional)) <= paths or mapping.messages and f"{mapping.messages}[]" in paths
    ]
    return mark, max(fits, key=lambda x: x[0], default=(0, None))[1]


def as_text(value) -> str:
    """Null is empty; a text stays; anything else is its JSON."""
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """Canonical (role, text) in order."""
    turns = [(role, as_text(record[f])) for role, f in mapping.fields if f in record and (record[f] is not None or f not in mapping.optional)]
    items = record.get(mapping.messages) or [] if mapping.messages else [record] if mapping.role else []
    for item in items:
        item = item if isinstance(item, dict) else {mapping.text: item}
        field, _, part = mapping.text.partition("[].")
        value = item.get(field)
        if part and isinstance(value, list):
            value = "".join(as_text(x.get(part)) if isinstance(x, dict) else as_text(x) for x in value)
        role = as_text(item.get(mapping.role))
        turns.append((ROLES.get(role, role), as_text(value)))
    return turns


def escaped(text: str) -> str:
    """No control string is left, and :func:`unescaped` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def marked(role: str, text: str) -> tuple[str, int, int]:
    """A turn's marked text, and where in it the part under the loss mask starts and ends (assistants' texts)."""
    head = f"{START}{escaped(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escaped(text)
    loss = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
    return f"{head}{body}{END}\n", *loss


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns = []
    for turn in formatted.split(f"{END}\n")[:-1]:
        head, _, body = turn.removeprefix(START).partition("\n")
        turns.append((unescaped(head), unescaped(body)))
    return turns


TURNS = "conv_id long, place long, part int, layout string, fingerprint string, role string, text string, formatted string, loss_start int, loss_end int"


def formatted_turns(records: DataFrame, id_col: str = "conv_id", place_col: str = "place", record_col: str = "record") -> DataFrame:
    """One row per turn, in order of ``place`` and ``part`` within a conversation (``TURNS``).

    ``formatted`` of a conversation's turns, one after another, is its formatted text; characters from
    ``loss_start`` to ``loss_end`` of each (code points) are under the loss mask. A record that is null, no JSON
    object or of no known layout gives one row with a null layout and null role, text and formatted text. A null
    place comes first; a null text is empty; a repeated record gives its turns again. No turn needs another one,
    so a conversation of any length is spread over all tasks.
    """
    rows = records.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(place_col).cast("long").alias("place"), F.col(record_col).cast("string").alias("record")
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = registry()
        names = [f.split()[0] for f in TURNS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 5, pa.int32(), pa.int32()]
        for batch in batches:
            out: list[tuple] = []
            for conv, place, text in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    record = json.loads(text) if text is not None else None
                except ValueError:
                    record = None
                mark, mapping = select(record, known)
                if mapping is None:
                    out.append((conv, place, 0, None, mark, None, None, None, 0, 0))
                    continue
                for part, (role, said) in enumerate(turns_of(record, mapping)):
                    out.append((conv, place, part, mapping.name, mark, role, said, *marked(role, said)))
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(convert, TURNS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says when it is read back (``DIGESTS``).

    Turns are sorted by conversation and read one after another, so a task holds one turn at a time, however
    long the conversation is. Rows without a formatted text are not turns.
    """
    columns = ["conv_id", "place", "part", "formatted", "loss_start", "loss_end"]
    ordered = turns.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "place", "part", "formatted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        close = lambda s: (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])
        state, done = None, []
        for batch in batches:
            for conv, _, _, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(close(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if text is None:
                    continue
                for role, said in read_back(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                under = unescaped(text[start:end])
                state[3] += len(under)
                state[4].update(under.encode())
                state[5] += len(text)
            if done:
                yield pack(done)
                done = []
        if state is not None:
            yield pack([*done, close(state)])

    return ordered.mapInArrow(read, DIGESTS)
