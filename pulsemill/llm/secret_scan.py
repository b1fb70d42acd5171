r"""Secret scan through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the trigrams that any match must contain: an OR of
ANDs. Every CHARS characters of documents are a segment with its own inverted index (trigram -> documents), built over the segment's
whole folded texts for the trigrams that the rules ask for. The query's postings are intersected and united, and only the
candidates are read by the regular expression. A rule without mandatory trigrams reads every document.

Segments need no shuffle and no state: a lost executor's segments are built again from the input.
"""

from __future__ import annotations

import functools
import hashlib
import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHARS, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret. least: characters that the group must have, else the match is dropped without a retry."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


_NAMES = "|".join(["password", "passwd", "secret", "token", "api_?key"])
_NAMES = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _NAMES)

#: The base kinds come first, in the order that breaks ties between spans. A shorter run of [0-9a-f] can't match, so {24,} finds the same runs as + with a check.
BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: What the scan adds: headers of private keys and tokens with a fixed prefix.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings that a part of a pattern may stand for; beyond this many, the part counts as unknown.
_MOST = 16


def _strings(items) -> list[list[str] | None]:
    """A pattern's parts in order: each is the few strings it may stand for, or None for what is unknown."""
    parts: list[list[str] | None] = []
    for op, arg in items:
        if op is sre.LITERAL:
            parts.append([chr(arg).lower()])
        elif op is sre.IN:
            chars = {chr(x).lower() for kind, x in arg if kind is sre.LITERAL}
            parts.append(sorted(chars) if len(chars) <= _MOST and all(kind is sre.LITERAL for kind, _ in arg) else None)
        elif op is sre.SUBPATTERN:
            parts += _strings(arg[3])
        elif op is sre.BRANCH:
            each = [_joined(_strings(x)) for x in arg[1]]
            parts.append(None if None in each else sorted({s for x in each for s in x}))
        elif op is sre.MAX_REPEAT and arg[0] == 0 and arg[1] == 1:
            inner = _joined(_strings(arg[2]))
            parts.append(None if inner is None else sorted({"", *inner}))
        elif op is sre.MAX_REPEAT and arg[0] > 0:
            parts += _strings(arg[2]) + [None]
        else:
            parts.append(None)
    return parts


def _joined(parts) -> list[str] | None:
    if any(p is None for p in parts) or int(np.prod([len(p) for p in parts] or [1])) > _MOST:
        return None
    return ["".join(x) for x in product(*parts)]


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of folded trigrams that any match must contain; None if the pattern has no mandatory trigram.

    Runs of known parts between unknown ones give alternatives; the run whose poorest alternative has most trigrams wins.
    """
    best: list[frozenset[str]] | None = None
    run: list[list[str]] = []
    for part in [*_strings(sre_parser.parse(pattern)), None]:
        if part is not None and int(np.prod([len(p) for p in [*run, part]])) <= _MOST:
            run.append(part)
            continue
        options = _joined(run) or [""]
        ands = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in options]
        if all(ands) and (best is None or min(map(len, ands)) > min(map(len, best))):
            best = ands
        run = [] if part is None else [part]
    return best


class Segment:
    """Inverted index of one batch of texts for the trigrams in `wanted`, over folded UTF-8 bytes."""

    def __init__(self, texts: list[str], wanted: list[str]):
        self.n = len(texts)
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        starts = np.cumsum([0, *(len(r) + 3 for r in raw)])  # three bytes apart, so no trigram spans two texts
        data = np.frombuffer(b"\0\0\0".join(raw) + b"\0\0\0", np.uint8).astype(np.uint32)
        codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        asked = np.zeros(1 << 24, bool)
        number = {int.from_bytes(t.encode(), "big"): t for t in wanted}
        asked[list(number)] = True
        at = np.nonzero(asked[codes])[0]
        found = np.unique((codes[at].astype(np.uint64) << np.uint64(32)) | (np.searchsorted(starts, at, side="right") - 1).astype(np.uint64))
        codes, docs = found >> np.uint64(32), (found & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.postings = {t: docs[np.searchsorted(codes, c) : np.searchsorted(codes, c, side="right")] for c, t in number.items()}

    def candidates(self, query: list[frozenset[str]] | None) -> np.ndarray:
        if query is None:
            return np.arange(self.n)
        either = [functools.reduce(functools.partial(np.intersect1d, assume_unique=True), sorted((self.postings[t] for t in ands), key=len)) for ands in query]
        return np.unique(np.concatenate(either))


def _scan(batches, rules: tuple[Rule, ...]):
    """Spans of each text as kind:start:end (code points), by start and then by the rules' order."""
    compiled = [(r, re.compile(r.pattern), trigram_query(r.pattern)) for r in rules]
    wanted = sorted({t for _, _, q in compiled for ands in q or () for t in ands})
    for pdf in batches:
        for part in slices(pdf, CHARS):  # the index takes some bytes for each byte of text, whatever the number of rows
            texts = ["" if t is None else t for t in part["text"]]
            index = Segment(texts, wanted)
            spans: list[list[tuple]] = [[] for _ in texts]
            for k, (rule, regex, query) in enumerate(compiled):
                for i in index.candidates(query):
                    spans[i] += [(m.start(), k, m.end()) for m in regex.finditer(texts[i]) if len(m[rule.group]) >= rule.least]
            yield pd.DataFrame({
                "doc_id": part["doc_id"].astype("Int64").to_numpy(),
                "text": part["text"].to_numpy(),
                "spans": [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(s)] for s in spans],
            })


SPANS = "array<struct<kind: string, start: int, end: int>>"


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text and spans (kind, start, end in code points) for every row of docs(doc_id, text, ...).

    A null text has no spans. Spans of different kinds may overlap; each kind's matches are leftmost and don't overlap.
    Repeated rows are scanned one by one; an empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInPandas(functools.partial(_scan, rules=rules), f"doc_id long, text string, spans {SPANS}")


def joined_spans(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base kinds' counts, base_sha256 and spans of scan_secrets()."""
    base = [r.kind for r in BASE_RULES]
    found = scan_secrets(docs, rules)
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in base), F.sha2(joined_spans(own), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def _mask(batches, rules: tuple[Rule, ...], mark: str):
    for pdf in (part for batch in batches for part in slices(batch, CHARS)):
        spans = pd.concat(list(_scan([pdf[["doc_id", "text"]]], rules)))["spans"]
        texts = []
        for text, found in zip(pdf["text"], spans):
            out, at = [], 0
            for s in found:
                if s["end"] > at:
                    out += [text[at : max(at, s["start"])], mark.format(s["kind"]) if s["start"] >= at else ""]
                    at = s["end"]
            texts.append("".join(out) + text[at:] if found else text)
        yield pdf.assign(text=texts)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[{}]") -> DataFrame:
    """docs with the same columns and rows; each secret in the column text is replaced by its kind's mark. Null texts stay null."""
    return docs.mapInPandas(functools.partial(_mask, rules=rules, mark=mark), docs.schema)
