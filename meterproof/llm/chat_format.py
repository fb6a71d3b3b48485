"""Chat formatting: a template compiler with generation marks, and the way back.

A template is cut into tokens, parsed into a syntax tree, folded where all parts are constant
and turned into Python closures. Templates are sandboxed: they see the names they are given,
keys of dicts and the filters below; there are no calls, no attributes of Python objects and
no loops but over given sequences. Messages may be a stream that is walked once, so a
conversation of any length is rendered turn by turn.

Language: `{{ expression }}`, `{% for x in seq %}` (with loop.index0, loop.first, loop.last),
`{% if %}/{% elif %}/{% else %}`, `{% set name = expression %}`, `{% generation %}` around
text the model should learn, `{#- comments -#}`, `-` inside a tag to trim white space.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import small_batches

TURN_END = "</turn>"
TEMPLATE = (
    "{% for m in messages %}### {{ m.role | label }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}" + TURN_END + "\n{% endfor %}"
)
LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}
ROLES = {label: role for role, label in LABELS.items()}
MAX_SOURCE, MAX_DEPTH, PART_CHARS = 65_536, 50, 65_536

_ESCAPED = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


class TemplateError(ValueError):
    """A template that does not parse, or that asks for something outside the sandbox."""


def escape(text: str) -> str:
    r"""Breaks every `###` and `</turn>` with a backslash and doubles backslashes, so that the
    result holds no control string and `unescape` gives the text back."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text) if "\\" in text else text


def label(role: str) -> str:
    """Name of a role in a turn's head; other roles than the usual ones are spelt out, escaped."""
    return LABELS.get(role) or "=" + escape(role).replace(": ", ":\\ ")


def role_of(name: str) -> str:
    return ROLES[name] if name in ROLES else unescape(name[1:])


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": escape, "label": label, "trim": lambda v: v.strip(), "upper": lambda v: v.upper(),
    "lower": lambda v: v.lower(), "capitalize": lambda v: v.capitalize(), "length": len, "string": str,
}
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_TAG = re.compile(r"\{%-?\s*(.*?)\s*-?%\}|\{\{-?\s*(.*?)\s*-?\}\}|\{#.*?#\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z]\w*)|(==|!=|<=|>=|[-+~<>()\[\].|]))""")
_QUOTED = {"n": "\n", "t": "\t", "r": "\r"}


# --- expressions: a tuple is (kind, ...); ("const", value) is what folding leaves ---


class _Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, quoted, name, sign = found.groups()
            if number:
                self.tokens.append(("const", int(number)))
            elif quoted:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda m: _QUOTED.get(m[1], m[1]), quoted[1:-1])))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = found.end()
        self.at = self.depth = 0

    def next_is(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in texts:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, text: str) -> None:
        if not self.next_is(text):
            raise TemplateError(f"expected {text!r}")

    def whole(self) -> tuple:
        found = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def choice(self) -> tuple:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("expression too deep")
        value = self.either()
        if self.next_is("if"):
            test = self.either()
            other = self.choice() if self.next_is("else") else ("const", "")
            value = ("choice", test, value, other)
        self.depth -= 1
        return value

    def either(self) -> tuple:
        left = self.both()
        while self.next_is("or"):
            left = ("or", left, self.both())
        return left

    def both(self) -> tuple:
        left = self.negation()
        while self.next_is("and"):
            left = ("and", left, self.negation())
        return left

    def negation(self) -> tuple:
        inverted = False
        while self.next_is("not"):
            inverted = not inverted
        value = self.comparison()
        return ("not", value) if inverted else value

    def comparison(self) -> tuple:
        left = self.joined()
        while sign := self.next_is(*_COMPARE):
            left = ("compare", sign, left, self.joined())
        return left

    def joined(self) -> tuple:
        left = self.sum()
        while self.next_is("~"):
            left = ("join", left, self.sum())
        return left

    def sum(self) -> tuple:
        left = self.filtered()
        while sign := self.next_is("+", "-"):
            left = ("add" if sign == "+" else "subtract", left, self.filtered())
        return left

    def filtered(self) -> tuple:
        value = self.operand()
        while self.next_is("|"):
            kind, name = self.take()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = ("filter", name, value)
        return value

    def take(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def operand(self) -> tuple:
        kind, value = self.take()
        if (kind, value) == ("sign", "("):
            found = self.choice()
            self.need(")")
        elif kind == "const":
            found = (kind, value)
        elif kind == "name":
            found = ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)
        else:
            raise TemplateError(f"unexpected {value!r}")
        while sign := self.next_is(".", "["):
            if sign == ".":
                kind, key = self.take()
                if kind != "name":
                    raise TemplateError("a dot needs a name")
                found = ("key", found, ("const", key))
            else:
                found = ("key", found, self.choice())
                self.need("]")
        return found


def fold(tree: tuple) -> tuple:
    """Computes what depends on constants only; a constant test leaves one branch."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    parts = tuple(fold(p) if isinstance(p, tuple) else p for p in tree[1:])
    inner = [p for p in parts if isinstance(p, tuple)]
    if all(p[0] == "const" for p in inner):
        try:
            return ("const", evaluator((kind, *parts))({}))
        except (TypeError, AttributeError) as error:
            raise TemplateError(f"constant expression fails: {error}") from error
    if kind == "choice" and parts[0][0] == "const":
        return parts[1] if parts[0][1] else parts[2]
    return (kind, *parts)


def _key(holder: Any, key: Any) -> Any:
    if not isinstance(holder, dict):
        raise TemplateError("only keys of dicts can be read")
    return holder.get(key)


def evaluator(tree: tuple) -> Callable[[dict], Any]:
    """A closure that computes an expression in a scope."""
    kind, *parts = tree
    if kind == "const":
        return lambda scope, value=parts[0]: value
    if kind == "name":
        return lambda scope, name=parts[0]: scope.get(name)
    if kind == "filter":
        return lambda scope, f=FILTERS[parts[0]], inner=evaluator(parts[1]): f(inner(scope))
    if kind == "compare":
        return lambda scope, f=_COMPARE[parts[0]], a=evaluator(parts[1]), b=evaluator(parts[2]): f(a(scope), b(scope))
    a, *rest = map(evaluator, parts)
    if kind == "not":
        return lambda scope: not a(scope)
    b = rest[0]
    if kind == "choice":
        return lambda scope, c=rest[1]: b(scope) if a(scope) else c(scope)
    return {
        "and": lambda scope: a(scope) and b(scope),
        "or": lambda scope: a(scope) or b(scope),
        "add": lambda scope: a(scope) + b(scope),
        "subtract": lambda scope: a(scope) - b(scope),
        "join": lambda scope: _shown(a(scope)) + _shown(b(scope)),
        "key": lambda scope: _key(a(scope), b(scope)),
    }[kind]


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- statements ---


def parse(source: str) -> list[tuple]:
    """Syntax tree of a template: text, out, for, if, set and generation nodes."""
    if len(source) > MAX_SOURCE:
        raise TemplateError("template too long")
    tokens, at = [], 0
    for tag in _TAG.finditer(source):
        text = source[at : tag.start()]
        if tokens and tokens[-1][2]:
            text = text.lstrip()
        if tag[0][2] == "-":
            text = text.rstrip()
        tokens.append(("text", text, False))
        kind = "block" if tag[1] is not None else "out" if tag[2] is not None else "note"
        tokens.append((kind, tag[1] or tag[2] or "", tag[0][-3] == "-"))
        at = tag.end()
    tail = source[at:]
    tokens.append(("text", tail.lstrip() if tokens and tokens[-1][2] else tail, False))
    tree, end, position = _body(tokens, 0, (), 0)
    return tree


def _body(tokens: list, at: int, ends: tuple[str, ...], depth: int) -> tuple[list[tuple], str, int]:
    if depth > MAX_DEPTH:
        raise TemplateError("blocks too deep")
    nodes: list[tuple] = []
    while at < len(tokens):
        kind, text, _ = tokens[at]
        at += 1
        if kind == "text":
            nodes.append(("text", text))
        elif kind == "out":
            nodes.append(("out", _Expression(text).whole()))
        elif kind == "block":
            word, _, rest = text.partition(" ")
            if word in ends:
                return nodes, text, at
            if word == "for":
                found = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not found:
                    raise TemplateError(f"cannot read for {rest!r}")
                body, _, at = _body(tokens, at, ("endfor",), depth + 1)
                nodes.append(("for", found[1], _Expression(found[2]).whole(), body))
            elif word == "if":
                branches, test = [], rest
                while True:
                    body, end, at = _body(tokens, at, ("elif", "else", "endif"), depth + 1)
                    branches.append((_Expression(test).whole(), body))
                    if end == "endif":
                        break
                    test = end.partition(" ")[2] if end.startswith("elif") else "true"
                nodes.append(("if", branches))
            elif word == "generation":
                body, _, at = _body(tokens, at, ("endgeneration",), depth + 1)
                nodes.append(("generation", body))
            elif word == "set" and (found := re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest, re.DOTALL)):
                nodes.append(("set", found[1], _Expression(found[2]).whole()))
            else:
                raise TemplateError(f"cannot read {text!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return nodes, "", at


def folded(nodes: list[tuple]) -> list[tuple]:
    """The tree without constant expressions, decided branches and neighbouring texts."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for kind, *parts in nodes:
        if kind == "out":
            tree = fold(parts[0])
            add(("text", _shown(tree[1])) if tree[0] == "const" else ("out", tree))
        elif kind == "for":
            add(("for", parts[0], fold(parts[1]), folded(parts[2])))
        elif kind == "generation":
            add(("generation", folded(parts[0])))
        elif kind == "set":
            add(("set", parts[0], fold(parts[1])))
        elif kind == "if":
            left = []
            for test, body in parts[0]:
                test = fold(test)
                if test[0] == "const" and not test[1]:
                    continue
                left.append((test, folded(body)))
                if test[0] == "const":
                    break
            if left and left[0][0][0] == "const":
                for node in left[0][1]:
                    add(node)
            elif left:
                add(("if", left))
        else:
            add((kind, *parts))
    return out


Render = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def renderer(nodes: list[tuple]) -> Render:
    """A closure that yields (text, under a generation mark) pieces in a scope."""
    steps = [_step(node) for node in nodes]

    def run(scope: dict, marked: bool) -> Iterator[tuple[str, bool]]:
        for step in steps:
            yield from step(scope, marked)

    return run


def _step(node: tuple) -> Render:
    kind, *parts = node
    if kind == "text":
        return lambda scope, marked, text=parts[0]: iter(((text, marked),))
    if kind == "out":
        value = evaluator(parts[0])
        return lambda scope, marked: iter(((_shown(value(scope)), marked),))
    if kind == "set":
        value = evaluator(parts[1])

        def assign(scope: dict, marked: bool) -> Iterator[tuple[str, bool]]:
            scope[parts[0]] = value(scope)
            return iter(())

        return assign
    if kind == "generation":
        body = renderer(parts[0])
        return lambda scope, marked: body(scope, True)
    if kind == "if":
        branches = [(evaluator(test), renderer(body)) for test, body in parts[0]]

        def decide(scope: dict, marked: bool) -> Iterator[tuple[str, bool]]:
            return next((body(scope, marked) for test, body in branches if test(scope)), iter(()))

        return decide
    name, sequence, body = parts[0], evaluator(parts[1]), renderer(parts[2])

    def loop(scope: dict, marked: bool) -> Iterator[tuple[str, bool]]:
        items = iter(sequence(scope) or ())
        end = object()
        item, index = next(items, end), 0
        while item is not end:
            following = next(items, end)
            inner = {**scope, name: item, "loop": {"index0": index, "first": index == 0, "last": following is end}}
            yield from body(inner, marked)
            item, index = following, index + 1

    return loop


@lru_cache(maxsize=16)
def compiled(source: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """Source of a template to a function from messages to marked pieces of text."""
    run = renderer(folded(parse(source)))
    return lambda messages: run({"messages": messages}, False)


# --- Spark ---


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict]]]:
    """Runs of rows with one conversation id, as a stream of messages each."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    held = next(rows, None)

    def messages(conversation):
        nonlocal held
        while held is not None and held[0] == conversation:
            yield {"role": held[1], "text": held[2]}
            held = next(rows, None)

    while held is not None:
        conversation = held[0]
        stream = messages(conversation)
        yield conversation, stream
        for _ in stream:
            pass


def _parts(id_type: pa.DataType):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.schema([("conv_id", id_type), ("part", pa.int64()), ("start", pa.int64()), ("formatted", pa.string()), ("spans", spans_type)])


def _formatting(source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(source)
        first = next(batches, None)
        if first is None:
            return
        schema = _parts(first.schema.field(0).type)
        out: list[tuple] = []
        held = 0

        def flush():
            nonlocal out, held
            done, out, held = out, [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        def chained():
            yield first
            yield from batches

        for conversation, messages in _conversations(chained()):
            part = start = at = 0
            text: list[str] = []
            spans: list[dict] = []
            for piece, marked in render(messages):
                text.append(piece)
                if marked and piece:
                    if spans and spans[-1]["end"] == at:
                        spans[-1]["end"] = at + len(piece)
                    else:
                        spans.append({"start": at, "end": at + len(piece)})
                at += len(piece)
                if at - start >= PART_CHARS:
                    out.append((conversation, part, start, "".join(text), spans))
                    part, start, text, spans, held = part + 1, at, [], [], held + at - start
                    if held > 1 << 22:
                        yield flush()
            out.append((conversation, part, start, "".join(text), spans))
            held += at - start
            if held > 1 << 22 or len(out) >= 1000:
                yield flush()
        if out:
            yield flush()

    return run


def format_conversations(rows: DataFrame, template: str = TEMPLATE, partitions: int | None = None) -> DataFrame:
    """Formatted text of every conversation of `rows` (conv_id, turn, role, text).

    Returns conv_id, part, start, formatted, spans: a conversation is one row, or several of
    about PART_CHARS characters (part counts from 0, start is the first character's place in
    the whole); spans are the places under a generation mark. Parts lie in order.

    Turns are ordered by turn, role, text, NULLs first. A NULL role or text counts as empty,
    rows with a NULL conv_id are one conversation, repeated rows are turns of their own,
    further columns are not read, and an empty table gives an empty result. A conversation is
    rendered as a stream: one with a third of all rows costs time, not memory.
    """
    compiled(template)
    small_batches(rows.sparkSession)
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = turns.repartition(partitions, "conv_id") if partitions else turns.repartition("conv_id")
    ordered = placed.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    kind = ordered.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(
        _formatting(template), f"conv_id {kind}, part long, start long, formatted string, spans array<struct<start:long,end:long>>"
    )


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    end = TURN_END + "\n"
    done: list[tuple] = []
    state: dict[str, Any] | None = None

    def close():
        assert not state["rest"], "the last turn does not end"
        done.append((state["id"], state["turns"], state["all"].hexdigest(), state["loss"], state["learnt"].hexdigest(), state["at"]))

    def batch_of(schema):
        rows, done[:] = list(done), []
        kinds = [schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = None
    for batch in batches:
        schema = batch.schema
        for conversation, part, _, text, spans in zip(*[c.to_pylist() for c in batch.columns]):
            if part == 0:
                if state:
                    close()
                state = {"id": conversation, "turns": 0, "all": hashlib.sha256(), "loss": 0, "learnt": hashlib.sha256(), "at": 0, "rest": "", "spans": []}
            whole, begin = state["rest"] + text, state["at"] - len(state["rest"])
            state["at"] += len(text)
            spans = state["spans"] + [(s["start"], s["end"]) for s in spans]
            used = 0
            while (cut := whole.find(end, used)) >= 0:
                head, _, body = whole[used:cut].removeprefix("### ").partition(": ")
                state["turns"] += 1
                state["all"].update(f"{role_of(head)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                while spans and spans[0][0] < begin + cut:
                    # A span that a part's end has cut goes on in the next one.
                    learnt = unescape(whole[spans[0][0] - begin : min(spans[0][1] - begin, cut)])
                    first = spans.pop(0)
                    while spans and spans[0][0] == first[1] and spans[0][0] < begin + cut:
                        first = (first[0], spans.pop(0)[1])
                        learnt = unescape(whole[first[0] - begin : min(first[1] - begin, cut)])
                    state["loss"] += len(learnt)
                    state["learnt"].update(learnt.encode("utf-8", "surrogatepass"))
                used = cut + len(end)
            state["rest"], state["spans"] = whole[used:], spans
        if len(done) >= 1000:
            yield batch_of(schema)
    if state:
        close()
        yield batch_of(schema)


def read_back(parts: DataFrame) -> DataFrame:
    """Turns and learnt text read back from what `format_conversations` made with TEMPLATE.

    `parts` must come straight from it, in its order. Per conversation: n_turns, a digest of
    all turns, the number and digest of the code points under the loss mask, and the length
    of the formatted text.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.mapInArrow(
        _reading, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
