"""Secrets in texts: strong patterns by themselves, weak parts of a credential only where others complete it.

Strong parts stand alone: assignments to a secret's name, access identifiers, long hexadecimal runs, and addresses that
carry a password. Weak parts are too common for that: identifiers (``user = ...``), unnamed or loosely named random
strings, and endpoints. Parts are intervals; two are in one scope if at most ``SCOPE`` characters lie between them. An
interval join within a document finds each weak part's partners:

* a random string is a secret if an access identifier is in scope, or both a weak identifier and an endpoint are;
* a weak identifier counts if a secret is in scope;
* an endpoint counts if both an identifier and a secret, strong or found so, are in scope.

The join sorts the partners once and looks up their neighbours, so a text with very many parts costs no pairs.

Edge cases: null and empty texts have no spans. Weak parts that overlap a strong one are dropped. Texts are read whole;
places count code points, the end is exclusive. Repeated rows are answered row by row; a column ``spans`` is replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import runs

SCOPE = 200
#: Bytes of text that a task turns into Python strings at a time.
TOGETHER = 2 << 20
#: Kinds in the order of ties; the first three are the base.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "address", "random", "identifier", "endpoint")
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

_FLAGS = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ADDRESS = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@'\"<>]++:[^\s/:@'\"<>]++@[^\s'\"<>]+", _FLAGS)
ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s'\"<>]{3,}"
                      r"|\b(?:host|hostname|server|endpoint|base_?url)\b[\"']?\x20*[:=]\x20*[\"']?[a-z0-9][a-z0-9.:/_-]{3,}", _FLAGS)
IDENTIFIER = re.compile(r"\b(?:user|username|user_?id|login|client_?id|account|account_?id|access_?key_?id|email)\b"
                        r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@+-]{3,}", _FLAGS)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")

Span = tuple[int, int]


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _alphabet(text: str) -> int:
    """Size of the alphabet that the letters and digits of a text are from: hexadecimal ones are told apart."""
    letters = {c for c in text if c.isalpha()}
    cased = 6 if {c.lower() for c in letters} <= set("abcdef") else 26
    return 10 * any(c.isdigit() for c in text) + cased * (any(c.islower() for c in letters) + any(c.isupper() for c in letters))


def _is_random(text: str) -> bool:
    """Whether a text looks drawn from its own alphabet: of near its full entropy, and with kinds of characters in turns.

    Kinds are capitals, small letters and digits. Joined words change kinds at their ends only and have capitals one by one, so where
    both cases occur more changes are asked for, and capitals side by side or digits; one case without digits is taken for words.
    """
    own = "".join(c for c in text if c.isalnum())
    if len(own) < 12:
        return False
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" for c in own]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / (len(own) - 1)
    if {"u", "l"} <= set(kinds):
        capitals = sum(a == b == "u" for a, b in zip(kinds, kinds[1:]))  # names have them one by one
        varied = changes >= 0.3 and capitals + kinds.count("d") >= 0.06 * len(own)
    else:
        varied = "d" in kinds and changes >= 0.1
    # Short texts can't show a whole alphabet: the entropy expected falls with the root of their length.
    size = _alphabet(own)
    return varied and _entropy(own) >= 0.75 * min(math.log2(size), math.log2(len(own)))


class _Near:
    """Which intervals have one of these within ``SCOPE``."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]
        self.reach = []
        for _, end in self.spans:
            self.reach.append(max(end, self.reach[-1]) if self.reach else end)

    def __contains__(self, span: Span) -> bool:
        at = bisect_left(self.starts, span[1] + SCOPE + 1)
        return at > 0 and self.reach[at - 1] >= span[0] - SCOPE


def _apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that overlap none of ``taken``."""
    taken = sorted(taken)
    starts, reach = [s for s, _ in taken], []
    for _, end in taken:
        reach.append(max(end, reach[-1]) if reach else end)
    return [s for s in spans if not (at := bisect_left(starts, s[1])) or reach[at - 1] <= s[0]]


def _found(pattern: re.Pattern, text: str) -> list[Span]:
    return [m.span() for m in pattern.finditer(text)]


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by start and then kind."""
    low = text.lower()
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if any(name in low for name in ("passw", "secret", "token", "apikey", "api_key")):
        out["assign"] = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out["access"] = _found(ACCESS, text)
    out["hex"] = _found(HEX, text)
    strong = [s for kind in BASE for s in out[kind]]
    links = "://" in text
    if links and "@" in text:
        out["address"] = _apart(_found(ADDRESS, text), strong)
        strong += out["address"]
    names = any(name in low for name in ("user", "login", "client", "account", "key", "email"))
    if strong or names:
        weak = _apart(_found(IDENTIFIER, text), strong) if names else []
        ends = _apart(_found(ENDPOINT, text), strong) if links or any(n in low for n in ("host", "server", "endp", "url")) else []
        if out["access"] or weak and ends:
            near = _Near(out["access"]), _Near(weak), _Near(ends)
            loose = _apart(_apart([m.span() for m in RANDOM.finditer(text) if _is_random(m[0])], strong), weak + ends)
            out["random"] = [s for s in loose if s in near[0] or s in near[1] and s in near[2]]
        secrets = _Near(out["assign"] + out["hex"] + out["address"] + out["random"])
        out["identifier"] = [s for s in weak if s in secrets]
        holders = _Near(out["access"] + out["identifier"])
        out["endpoint"] = _apart([s for s in ends if s in holders and s in secrets], out["identifier"])
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(((kind, a, b) for kind, own in out.items() for a, b in own), key=lambda s: (s[1], order[s[0]], s[2]))


def secret_spans(documents: DataFrame, column: str = "spans") -> DataFrame:
    """``documents`` with the column ``column``: kind, start and end of each secret, by start and then kind."""

    @F.arrow_udf("array<struct<kind: string, start: int, end: int>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans(t or "")] for t in part["text"].to_pylist()], SPANS)
                     for part in runs(pa.RecordBatch.from_arrays([texts], ["text"]), "text", TOGETHER)]
            yield pa.concat_arrays(parts) if parts else pa.array([], SPANS)

    return documents.withColumn(column, scan(F.col("text").cast("string")))


def without_secrets(text: str, mark: str) -> str:
    """``text`` in which all spans but endpoints give way to ``mark``."""
    parts, at = [], 0
    for kind, start, end in spans(text):
        if kind != "endpoint" and end > at:
            parts += [text[at: start], mark] if start >= at else []
            at = end
    return "".join(parts) + text[at:] if parts else text


def redact(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``documents`` (with text and n_chars) in which all spans but endpoints give way to ``mark``; no row goes.

    Secrets are found and replaced in one pass over a few megabytes of text at a time.
    """
    documents = documents.withColumn("text", F.col("text").cast("string"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, size = batch.schema.get_field_index("text"), batch.schema.get_field_index("n_chars")
            for part in runs(batch, "text", TOGETHER):
                old = part["text"].to_pylist()
                new = [t and without_secrets(t, mark) for t in old]
                hit = [a is not b for a, b in zip(old, new)]
                if any(hit):
                    counts = [len(t) if changed else n for changed, t, n in zip(hit, new, part["n_chars"].to_pylist())]
                    columns = list(part.columns)
                    columns[text], columns[size] = pa.array(new, part["text"].type), pa.array(counts, part["n_chars"].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return documents.mapInArrow(clean, documents.schema)
