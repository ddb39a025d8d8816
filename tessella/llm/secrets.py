"""Secret scans with multipart credential linking.

Base patterns are found first (assignments, access identifiers, long hex runs). The parts of credentials that say little
alone come on top: account identifiers, mixed tokens that look random, and endpoints. They are *weak*: one is reported
only if complementary parts lie in its scope: at most ``scope`` code points lie between the two (none if they overlap), and no
blank line:

* an identifier needs a secret (base or weak),
* a weak secret needs an identifier (or a base access identifier),
* an endpoint needs both an identifier and a secret.

Parts of a text are sorted by position, and each weak part is joined to the nearest complementary part on either side:
an interval join by merging, with no pairs enumerated. A scope lies within one text, so nothing is shuffled.

Defined results: null and empty texts have no spans; repeated rows each get theirs; positions are code points, end
exclusive; weak parts that overlap a base span count for nothing; of weak parts with all complements that overlap each other
(an identifier and a secret within an endpoint) the first, or else the longest, is reported.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base patterns (fixed values of the data contract): kind, pattern, group that must be long enough, least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Weak parts: words that name an account, random-looking tokens, endpoints.
IDENT = re.compile(
    r"""(?:user(?:_?name|_?id)?|login|client_?id|account(?:_?id|_?name)?|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
MIXED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]+|(?:host(?:name)?|endpoint|server|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z0-9.:/-]+|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?::\d+)?(?![\d.])""",
    re.IGNORECASE | re.ASCII,
)
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")
#: What complements a weak part.
NEEDS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("identifier", "secret")}
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
#: What must stand in a text before its slower patterns are worth a search.
ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
IDENT_WORDS = ("user", "login", "client", "account", "access", "key")
ENDPOINT_WORDS = ("://", "host", "endpoint", "server", "url")


def base_spans(text: str, folded: str) -> list[tuple[int, int, str]]:
    spans = []
    if any(w in folded for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def _random_looking(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def weak_parts(text: str, folded: str) -> list[tuple[int, int, str]]:
    parts = []
    if any(w in folded for w in IDENT_WORDS):
        parts += [(m.start(), m.end(), "identifier") for m in IDENT.finditer(text)]
    if any(w in folded for w in ENDPOINT_WORDS) or text.count(".") >= 3:
        parts += [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)]
    return parts


class Role:
    """The parts that can complement others in one way, by position."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]
        # Of the spans up to each, the one that ends last.
        self.last: list[tuple[int, int]] = []
        for s, e in self.spans:
            self.last.append(max(self.last[-1], (e, s)) if self.last else (e, s))

    def nearest(self, s: int, e: int, scope: int, blanks: list[int]) -> int | None:
        """Start of the part nearest to [s, e) in its scope (of equally near ones the left one)."""
        k = bisect_left(self.starts, s)
        found = []
        if k:
            end, start = self.last[k - 1]
            found.append((max(0, s - end), 0, start, end, s))
        if k < len(self.spans):
            found.append((max(0, self.starts[k] - e), 1, self.starts[k], e, self.starts[k]))
        for gap, _, start, low, high in sorted(found):
            if gap <= scope and bisect_left(blanks, low) == bisect_left(blanks, max(low, high)):
                return start
        return None


def linked_spans(text: str, scope: int = 200):
    """(all spans, links, base spans): weak parts with their complements; a link is (kind, start, kind, start)."""
    folded = text.lower()
    base = base_spans(text, folded)
    weak = weak_parts(text, folded)
    if not weak and not any(k == "access" for _, _, k in base):
        return base, [], base
    weak += [(m.start(), m.end(), "secret") for m in MIXED.finditer(text) if _random_looking(m[0])]
    taken = sorted((s, e) for s, e, _ in base)
    ends = [0]  # of the taken spans up to each, the last end
    for _, e in taken:
        ends.append(max(ends[-1], e))
    starts = [s for s, _ in taken]
    weak = [(s, e, kind) for s, e, kind in sorted(weak) if ends[bisect_left(starts, e)] <= s]
    blanks = [m.start() for m in BLANK_LINE.finditer(text)]
    roles = {
        "identifier": Role([(s, e) for s, e, k in weak if k == "identifier"] + [(s, e) for s, e, k in base if k == "access"]),
        "secret": Role([(s, e) for s, e, k in weak if k == "secret"] + [(s, e) for s, e, k in base if k in ("assign", "hex")]),
    }
    kept, links, last = [], [], 0
    for s, e, kind in sorted(weak, key=lambda x: (x[0], -x[1])):
        needs = NEEDS[kind]
        found = [(role, roles[role].nearest(s, e, scope, blanks)) for role in needs] if s >= last else [(None, None)]
        if all(at is not None for _, at in found):
            kept.append((s, e, kind))
            links += [(kind, s, role, at) for role, at in found]
            last = e
    return base + kept, links, base


def _joined(spans) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], order[x[2]], x[1])))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """(doc_id, base, found, links): arrays of spans (kind, start, end), and the links of weak parts as text."""

    def run(batches):
        for b in batches:
            base, found, links = [], [], []
            for text in b.column(1).to_pylist():
                everything, linked, own = linked_spans(text or "", scope)
                order = {k: i for i, k in enumerate(KINDS)}
                for spans, out in ((own, base), (everything, found)):
                    out.append([{"kind": k, "start": s, "end": e} for s, e, k in sorted(spans, key=lambda x: (x[0], order[x[2]], x[1]))])
                links.append([f"{a}:{x}-{c}:{y}" for a, x, c, y in linked])
            arrays = [b.column(0), pa.array(base, pa.list_(SPAN)), pa.array(found, pa.list_(SPAN)), pa.array(links, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "base", "found", "links"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, base {spans}, found {spans}, links array<string>")


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_secrets``."""
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    n = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("long")
    return found.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
        F.size("links").cast("long").alias("n_links"),
    )


def redact(text: str, scope: int = 200, mask: str = "[secret]") -> str:
    """The text with every reported span replaced."""
    out, at = [], 0
    for s, e, _ in sorted(linked_spans(text, scope)[0]):
        if e > at:
            out += [text[at : max(at, s)], mask]
            at = e
    return "".join(out) + text[at:]


def base_digest(text: str) -> str:
    return hashlib.sha256(_joined(base_spans(text, text.lower())).encode()).hexdigest()
