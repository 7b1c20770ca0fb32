"""Chat formatting by a template compiler.

Templates are written in a small sandboxed language, parsed into a syntax tree,
simplified by folding constants, and compiled into Python closures that yield
the pieces of the output one after another, so a conversation is rendered while
its turns arrive and never held whole.

    {{ expression }}                         output
    {% for x in xs %} ... {% endfor %}       loop.first, loop.index0
    {% if a %} {% elif b %} {% else %} {% endif %}
    {% set x = expression %}
    {% generation %} ... {% endgeneration %} text that the model learns to write
    {# comment #}

Expressions know strings, integers, true, false, none, names, x.key, x['key'],
+, ==, !=, <, <=, >, >=, in, not, and, or, and the filters of ``FILTERS``.  A
key reaches into dictionaries only; there are no calls, so a template can't
leave its data.

``escape`` puts a backslash into every control string of ``CONTROLS`` and
doubles backslashes; ``unescape`` undoes it exactly, whatever the text.

Defined results: null text and null role are empty; rows of one conversation
come by turn, ties by role and text; rows with a null conv_id are one
conversation of their own; an empty table gives the added conversations only.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import short_batches, table

TURN, END = "<|turn|>", "<|end|>"
#: Strings that steer a model or mark turns; a text that holds one is escaped.
CONTROLS = (TURN, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

TEMPLATE = (
    "{# one line for the role, then the text #}{% for m in messages %}{{ turn + (m.role | escape_line) + '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "{{ end + '\\n' }}{% endfor %}"
)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        if control in text:
            text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


_ESCAPED = re.compile(r"\\(.)", re.DOTALL).sub


def unescape(text: str) -> str:
    return _ESCAPED(lambda m: m[1], text) if "\\" in text else text


def unescape_line(text: str) -> str:
    return _ESCAPED(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


FILTERS: dict[str, Callable] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": lambda x: x.strip(),
    "upper": lambda x: x.upper(),
    "lower": lambda x: x.lower(),
    "length": len,
    "string": str,
}


class TemplateError(ValueError):
    pass


# ---------------------------------------------------------------- syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass
class Text:
    text: str


@dataclass
class Output:
    expr: object


@dataclass
class Assign:
    name: str
    expr: object


@dataclass
class For:
    name: str
    over: object
    body: list = field(default_factory=list)


@dataclass
class If:
    branches: list = field(default_factory=list)  # (condition, body)


@dataclass
class Generation:
    body: list = field(default_factory=list)


# ---------------------------------------------------------------- parser

_OPEN = re.compile(r"\{[{%#]")
_CLOSE = {"{{": "}}", "{%": "%}", "{#": "#}"}
_STRING = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+|.\[\]()=]))")
_LITERALS = {"true": True, "false": False, "none": None}
_COMPARE = {"==", "!=", "<", "<=", ">", ">=", "in"}


class _Expressions:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str | None, str | None]:
        return self.tokens[self.at] if self.at < len(self.tokens) else (None, None)

    def take(self, *values: str) -> str | None:
        kind, value = self.peek()
        if value in values and kind in ("op", "name"):
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"expected a name, found {value!r}")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def expression(self):
        out = self.conjunction()
        while self.take("or"):
            out = Op("or", (out, self.conjunction()))
        return out

    def conjunction(self):
        out = self.negation()
        while self.take("and"):
            out = Op("and", (out, self.negation()))
        return out

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        out = self.sum()
        while op := self.take(*_COMPARE):
            out = Op(op, (out, self.sum()))
        return out

    def sum(self):
        out = self.filtered()
        while self.take("+"):
            out = Op("+", (out, self.filtered()))
        return out

    def filtered(self):
        out = self.postfix()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Filter(name, out)
        return out

    def postfix(self):
        out = self.atom()
        while True:
            if self.take("."):
                out = Key(out, Const(self.name()))
            elif self.take("["):
                out = Key(out, self.expression())
                self.need("]")
            else:
                return out

    def atom(self):
        kind, value = self.peek()
        if self.take("("):
            out = self.expression()
            self.need(")")
            return out
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value not in ("and", "or", "not", "in"):
            return Const(_LITERALS[value]) if value in _LITERALS else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def _parts(source: str) -> Iterator[str]:
    """Texts and whole tags in order; a tag ends at its mark outside of strings."""
    at = 0
    while m := _OPEN.search(source, at):
        if m.start() > at:
            yield source[at : m.start()]
        close, end = _CLOSE[m[0]], m.end()
        while not source.startswith(close, end):
            if end >= len(source):
                raise TemplateError(f"{m[0]!r} isn't closed")
            string = _STRING.match(source, end) if m[0] != "{#" else None
            end = string.end() if string else end + 1
        at = end + len(close)
        yield source[m.start() : at]
    if at < len(source):
        yield source[at:]


def parse(source: str) -> list:
    root: list = []
    stack: list[tuple[str, object, list]] = [("", None, root)]
    for part in _parts(source):
        kind, node, body = stack[-1]
        if part.startswith("{#"):
            continue
        if part.startswith("{{"):
            e = _Expressions(part[2:-2])
            body.append(Output(e.expression()))
            e.end()
        elif part.startswith("{%"):
            e = _Expressions(part[2:-2])
            tag = e.name()
            if tag == "for":
                new = For(e.name(), None)
                e.need("in")
                new.over = e.expression()
                body.append(new)
                stack.append(("for", new, new.body))
            elif tag == "if":
                new = If([(e.expression(), [])])
                body.append(new)
                stack.append(("if", new, new.branches[0][1]))
            elif tag in ("elif", "else") and kind == "if":
                node.branches.append((Const(True) if tag == "else" else e.expression(), []))
                stack[-1] = ("if", node, node.branches[-1][1])
            elif tag == "set":
                new = Assign(e.name(), None)
                e.need("=")
                new.expr = e.expression()
                body.append(new)
            elif tag == "generation":
                new = Generation()
                body.append(new)
                stack.append(("generation", new, new.body))
            elif tag.startswith("end") and tag[3:] == kind and kind:
                stack.pop()
            else:
                raise TemplateError(f"unexpected tag {tag!r}")
            e.end()
        elif part:
            body.append(Text(part))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} isn't closed")
    return root


# ---------------------------------------------------------------- constants

_APPLY: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def fold(node, constants: dict):
    """The same expression with all that is known worked out."""
    if isinstance(node, Name):
        return Const(constants[node.name]) if node.name in constants else node
    if isinstance(node, Filter):
        of = fold(node.of, constants)
        return Const(FILTERS[node.name](of.value)) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Key):
        return Key(fold(node.of, constants), fold(node.key, constants))
    if isinstance(node, Op):
        args = tuple(fold(a, constants) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            return Const(_APPLY[node.op](*(a.value for a in args)))
        if node.op == "+" and isinstance(args[1], Const) and isinstance(args[0], Op) and args[0].op == "+" and isinstance(args[0].args[1], Const):
            inner = args[0]  # (x + 'a') + 'b'
            return Op("+", (inner.args[0], Const(inner.args[1].value + args[1].value)))
        return Op(node.op, args)
    return node


def simplify(body: list, constants: dict) -> list:
    """The body with constants folded, dead branches gone and neighbouring texts joined."""
    constants = {k: v for k, v in constants.items() if k not in _assigned(body)}
    out: list = []
    for node in body:
        if isinstance(node, Output):
            e = fold(node.expr, constants)
            new = [Text(str(e.value))] if isinstance(e, Const) else [Output(e)]
        elif isinstance(node, Assign):
            new = [Assign(node.name, fold(node.expr, constants))]
        elif isinstance(node, For):
            inner = {k: v for k, v in constants.items() if k not in (node.name, "loop")}
            new = [For(node.name, fold(node.over, constants), simplify(node.body, inner))]
        elif isinstance(node, Generation):
            new = [Generation(simplify(node.body, constants))]
        elif isinstance(node, If):
            branches, new = [], []
            for condition, inner in node.branches:
                c = fold(condition, constants)
                if isinstance(c, Const) and not c.value:
                    continue
                branches.append((c, simplify(inner, constants)))
                if isinstance(c, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                new = branches[0][1]
            elif branches:
                new = [If(branches)]
        else:
            new = [node]
        for n in new:
            if isinstance(n, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + n.text)
            elif not (isinstance(n, Text) and not n.text):
                out.append(n)
    return out


def _assigned(body: list) -> set[str]:
    out: set[str] = set()
    for node in body:
        if isinstance(node, Assign):
            out.add(node.name)
        elif isinstance(node, (For, Generation)):
            out |= _assigned(node.body)
        elif isinstance(node, If):
            for _, inner in node.branches:
                out |= _assigned(inner)
    return out


# ---------------------------------------------------------------- compiler

#: Markers between pieces of output.
BEGIN, STOP = object(), object()


def _expression(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        def name(scope, n=node.name):
            if n not in scope:
                raise TemplateError(f"no value {n!r}")
            return scope[n]
        return name
    if isinstance(node, Key):
        of, key = _expression(node.of), _expression(node.key)

        def get(scope):
            x = of(scope)
            if type(x) is not dict:
                raise TemplateError("only dictionaries have keys")
            return x.get(key(scope))
        return get
    if isinstance(node, Filter):
        of, f = _expression(node.of), FILTERS[node.name]
        return lambda scope: f(of(scope))
    a = _expression(node.args[0])
    if node.op == "not":
        return lambda scope: not a(scope)
    b = _expression(node.args[1])
    if node.op == "and":
        return lambda scope: a(scope) and b(scope)
    if node.op == "or":
        return lambda scope: a(scope) or b(scope)
    apply = _APPLY[node.op]
    return lambda scope: apply(a(scope), b(scope))


def _block(body: list) -> Callable[[dict], Iterator]:
    steps = [_statement(n) for n in body]

    def run(scope):
        for step in steps:
            yield from step(scope)
    return run


def _statement(node) -> Callable[[dict], Iterator]:
    if isinstance(node, Text):
        return lambda scope, pieces=(node.text,): pieces
    if isinstance(node, Output):
        e = _expression(node.expr)
        return lambda scope: (str(e(scope)),)
    if isinstance(node, Assign):
        e = _expression(node.expr)

        def assign(scope):
            scope[node.name] = e(scope)
            return ()
        return assign
    if isinstance(node, For):
        over, body = _expression(node.over), _block(node.body)

        def loop(scope):
            outer = {k: scope[k] for k in (node.name, "loop") if k in scope}
            for i, x in enumerate(over(scope)):
                scope[node.name] = x
                scope["loop"] = {"index0": i, "first": i == 0}
                yield from body(scope)
            for k in (node.name, "loop"):
                scope.pop(k, None)
            scope.update(outer)
        return loop
    if isinstance(node, If):
        branches = [(_expression(c), _block(b)) for c, b in node.branches]

        def choose(scope):
            for condition, body in branches:
                if condition(scope):
                    return body(scope)
            return ()
        return choose
    body = _block(node.body)

    def generation(scope):
        yield BEGIN
        yield from body(scope)
        yield STOP
    return generation


def compile_template(source: str = TEMPLATE, **constants) -> Callable[[dict], Iterator]:
    """A function of the values that yields pieces of output and the markers BEGIN and STOP."""
    run = _block(simplify(parse(source), {"turn": TURN, "end": END} | constants))
    return lambda values: run(dict(values))


def render(template: Callable, values: dict) -> tuple[str, list[tuple[int, int]]]:
    """The whole output and the spans under the loss mask, in code points."""
    out, spans, at = [], [], 0
    for piece in template(values):
        if piece is BEGIN:
            begin = at
        elif piece is STOP:
            spans.append((begin, at))
        else:
            out.append(piece)
            at += len(piece)
    return "".join(out), spans


# ---------------------------------------------------------------- reading back


class Reader:
    """Takes an output piece by piece and tells its turns and what is under the mask; holds one turn at most."""

    def __init__(self):
        self.text, self.chars, self.turns, self.begin = "", 0, 0, None
        self.whole, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0
        self.said = None

    def feed(self, piece) -> None:
        if piece is BEGIN:
            self.begin = len(self.text)
        elif piece is STOP:
            learnt = unescape(self.text[self.begin :])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode("utf-8", "surrogatepass"))
        else:
            self.chars += len(piece)
            self.text += piece
            if self.text.endswith(END + "\n"):
                self._turn(self.text)
                self.text = ""

    def _turn(self, text: str) -> None:
        if not text.startswith(TURN):
            raise ValueError("a turn doesn't begin with its mark")
        role, _, said = text[len(TURN) : -len(END) - 1].partition("\n")
        self.turns += 1
        for part in (unescape_line(role), unescape(said)):
            self.whole.update((part + "\n").encode("utf-8", "surrogatepass"))

    def result(self) -> tuple:
        if self.text:
            raise ValueError("the last turn isn't closed")
        return self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for conv, some in itertools.groupby(rows, key=lambda r: r[0]):
        yield conv, ({"role": role or "", "text": text or ""} for _, role, text in some)


def _ordered(conversations: DataFrame) -> DataFrame:
    return conversations.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, formatted, loss_spans (start, end in code points) of each conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = compile_template(template)
        for conv, messages in _conversations(batches):
            text, spans = render(write, {"messages": messages})
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([text]), pa.array([[{"start": a, "end": b} for a, b in spans]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "formatted", "loss_spans"])

    short_batches(conversations.sparkSession)
    return _ordered(conversations).mapInArrow(run, "conv_id long, formatted string, loss_spans array<struct<start: long, end: long>>")


def digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """What can be read back from each formatted conversation, in digests; turns stream through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = compile_template(template)
        rows: list[tuple] = []

        def out():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for conv, messages in _conversations(batches):
            reader = Reader()
            for piece in write({"messages": messages}):
                reader.feed(piece)
            rows.append((conv, *reader.result()))
            if len(rows) >= 5000:
                yield out()
                rows = []
        if rows:
            yield out()

    short_batches(conversations.sparkSession)
    return _ordered(conversations).mapInArrow(run, SCHEMA)


#: A conversation of nothing but control strings, which must survive.
HOSTILE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame([(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)], "conv_id long, turn long, role string, text string")
    return digests(rows.withColumn("turn", rows["turn"].cast("long")).unionByName(hostile))
