"""Personal data: patterns propose, checksums confirm, context words adjust the score.

Built-in functions only. For each kind the text is cut at the matches of its pattern; the
lengths of gaps and matches give the places. Base kinds (email, ip, card, phone) always
stay when their validator accepts them. The method adds two kinds: `iban`, confirmed by its
mod-97 checksum, and `ssn`, which has no checksum and counts only beside a context word.
Every span carries a score: the kind's own, raised when one of the kind's words stands in
the 40 characters before the match.

Patterns are written so that a match attempt starts only where one can succeed (at the end
of the last match or of another run of characters), with possessive loops: a very long run
costs linear time and no stack. Places are summed in two levels, so a text with very many
matches stays cheap.

Defined cases: a null or empty text has no spans and stays as it is; repeated documents are
each searched; matches that a validator refuses are dropped without a second try. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import carried, quoted

CONTEXT_CHARS = 40
KEEP_SCORE = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without this pattern has no match
    valid: str  # SQL over the match `m`
    score: float
    words: str  # context words before a match
    lift: float = 0.2
    base: bool = True


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        "true",
        0.8,
        "e?mail|contact|write|reach",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
        r"[0-9]\.[0-9]",
        "forall(transform(split(m, '[.]'), p -> trim(leading '0' from p)),"
        " p -> length(p) <= 3 and coalesce(try_cast(p as int), 0) <= 255)",
        0.6,
        "ip|host|server|address|login",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9])++",
        r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
        "length(regexp_replace(m, '[ -]', '')) between 16 and 19 and luhn_check(regexp_replace(m, '[ -]', ''))",
        0.8,
        "card|visa|credit|pay|account",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9]",
        "length(regexp_replace(m, '[^0-9]', '')) between 8 and 15",
        0.6,
        "phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}",
        "aggregate(split(concat(substr(m, 5), substr(m, 1, 4)), ''), 0, (r, c) -> case"
        " when c between '0' and '9' then (r * 10 + ascii(c) - 48) % 97"
        " when c between 'A' and 'Z' then (r * 100 + ascii(c) - 55) % 97 else r end) = 1",
        0.7,
        "iban|bank|account|konto|transfer",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "substr(m, 1, 3) not in ('000', '666') and substr(m, 5, 2) != '00' and substr(m, 8) != '0000'",
        0.35,
        "ssn|social security",
        base=False,
    ),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running_sums(steps: str) -> str:
    """SQL for the running sums of an integer array, in blocks of the root of its length."""
    add = "(o, x) -> concat(o, array(element_at(o, -1) + x))"
    width = f"cast(ceil(sqrt(size({steps}))) as int)"
    blocks = f"transform(sequence(0, (size({steps}) - 1) div {width}), b -> slice({steps}, int(b) * {width} + 1, {width}))"
    inner = f"transform({blocks}, part -> aggregate(slice(part, 2, size(part)), slice(part, 1, 1), {add}))"
    # each block's sums, raised by the last sums of the blocks before it
    starts = f"aggregate(transform({inner}, s -> element_at(s, -1)), array(0), {add})"
    return f"flatten(zip_with({inner}, slice({starts}, 1, size({inner})), (s, a) -> transform(s, x -> x + a)))"


def find_spans(docs: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """Documents with `spans`: array of (kind, start, end, score, found), by kind, then start."""
    names = carried(docs, None, ["spans"])
    rows = docs.select(*[quoted(n) for n in names], F.coalesce(quoted(text).cast("string"), F.lit("")).alias("_text"))
    for k in kinds:
        pattern, none = _literal(k.pattern), "cast(array() as array<string>)"
        rows = rows.withColumn(
            "_match", F.expr(f"if(_text rlike {_literal(k.needs)}, regexp_extract_all(_text, {pattern}, 0), {none})")
        )
        rows = rows.withColumn("_gap", F.expr(f"if(size(_match) > 0, split(_text, {pattern}, -1), {none})"))
        rows = rows.withColumn(
            "_step", F.expr("zip_with(_match, slice(_gap, 1, size(_match)), (m, g) -> length(m) + length(g))")
        )
        rows = rows.withColumn("_end", F.expr(f"if(size(_step) > 1, {_running_sums('_step')}, _step)"))
        score = f"{k.score} + if(lower(right(g, {CONTEXT_CHARS})) rlike {_literal(f'(?:^|[^a-z])(?:{k.words})')}, {k.lift}, 0.0)"
        made = (
            f"zip_with(zip_with(_match, _gap, (m, g) -> if(m is null, null, struct(m, g))), _end, (p, e) ->"
            f" named_struct('kind', '{k.name}', 'start', e - length(p.m), 'end', e, 'score',"
            f" cast({score.replace('(g,', '(p.g,')} as double), 'found', p.m))"
        )
        kept = f"filter({made}, s -> s.found is not null and {k.valid.replace('(m,', '(s.found,')}"
        kept += ")" if k.base else f" and s.score >= {KEEP_SCORE})"
        rows = rows.withColumn(f"_{k.name}", F.expr(kept)).drop("_match", "_gap", "_step", "_end")
    spans = F.concat(*[F.col(f"_{k.name}") for k in kinds]).alias("spans")
    return rows.select(*[quoted(n) for n in names], spans)


def written(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def how_many(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span by its kind in brackets; overlapping spans become one, named by the first."""
    body, kinds = "coalesce(`" + text.replace("`", "``") + "`, '')", "array_sort(transform(spans, s -> struct(s.start, s.end, s.kind)))"
    cut = (
        f"aggregate({kinds}, named_struct('at', 0, 'parts', cast(array() as array<string>)), (a, s) ->"
        f" if(s.start >= a.at, named_struct('at', s.end, 'parts', concat(a.parts, array("
        f"substr({body}, a.at + 1, s.start - a.at), concat('[', upper(s.kind), ']')))),"
        f" named_struct('at', greatest(a.at, s.end), 'parts', a.parts)),"
        f" a -> concat(array_join(a.parts, ''), substr({body}, a.at + 1)))"
    )
    return found.withColumn(text, F.expr(f"if(size(spans) > 0, {cut}, `{text}`)"))
