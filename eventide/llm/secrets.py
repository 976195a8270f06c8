"""Secret scan with multipart credential linking (operator 1).

Base findings stand alone: ``assign`` (a key word, ``:`` or ``=``, a value of
8+ characters), ``access`` (an access id) and ``hex`` (32+ hex digits).

Other parts are weak alone: an ``identifier`` (client id, user name, ...), a
``secret`` (a mixed token of 16+ characters) or an ``endpoint`` (a URL or a
host).  They are reported only when complementary parts co-occur: parts are
intervals of the text; an interval join finds, within one scope (text
between blank lines) and ``reach`` characters, the nearest identifier and
secret of each part.  A weak identifier needs a secret, a weak secret needs
an identifier, an endpoint needs both.  The join is a binary search in the
sorted intervals of a document, so a text with many parts stays linear.

Defined cases: null text is empty and has no finding; spans are code points,
end exclusive; rows keep their order and number, other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_col

# Fixed patterns of the base findings.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
MIN_VALUE = 8

IDENTIFIER = re.compile(r"""\b(?:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}""",
                        re.IGNORECASE | re.ASCII)
ID_KEYS = ("key", "client", "account", "user", "login")
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]{3,}|\b(?:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{4,}""",
                      re.ASCII)
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SCOPE = re.compile(r"\n[ \t]*\n")

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
RANK = {k: i for i, k in enumerate(KINDS)}
REACH = 400

Span = tuple[int, int, str]   # start, end, kind


def base_spans(text: str) -> list[Span]:
    """Base findings by start, then kind."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in KEYS):
            out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                    if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], RANK[s[2]], s[1]))


def _mixed(token: str) -> bool:
    """Digits and letters of either case, no single character above a third."""
    return (any(c.isdigit() for c in token) and any(c.islower() for c in token)
            and any(c.isupper() for c in token)
            and max(token.count(c) for c in set(token)) * 3 <= len(token))


def _clear(spans: list[Span], taken: list[Span]) -> list[Span]:
    """Spans that overlap none of ``taken`` (both sorted by start)."""
    reach, furthest = [], 0
    for s in taken:
        furthest = max(furthest, s[1])
        reach.append(furthest)
    starts = [s[0] for s in taken]
    return [s for s in spans if not (k := bisect_left(starts, s[1])) or reach[k - 1] <= s[0]]


class _Parts:
    """Parts of one role by scope, for the question whether one lies near an interval."""

    def __init__(self, spans: list[Span], scopes: list[int]):
        self.by: dict[int, tuple[list[int], list[int]]] = {}
        for a, z, _ in sorted(spans):
            starts, ends = self.by.setdefault(bisect_right(scopes, a), ([], []))
            starts.append(a)
            ends.append(max(z, ends[-1] if ends else z))

    def near(self, span: Span, scopes: list[int], reach: int) -> bool:
        got = self.by.get(bisect_right(scopes, span[0]))
        if not got:
            return False
        k = bisect_right(got[0], span[1] + reach)   # parts that start early enough
        return k > 0 and got[1][k - 1] >= span[0] - reach


def linked_spans(text: str, base: list[Span], reach: int = REACH) -> list[Span]:
    """Weak parts with complementary parts near them."""
    low = None
    ids: list[Span] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in ID_KEYS):
            ids = [(m.start(), m.end(), "identifier") for m in IDENTIFIER.finditer(text)]
    ids = _clear(ids, base)
    strong_ids = [s for s in base if s[2] == "access"]
    if not ids and not strong_ids:
        return []      # nothing complements a secret or an endpoint
    scopes = [m.start() for m in SCOPE.finditer(text)]
    ends = [(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)] if ":" in text or "=" in text else []
    ends = _clear(ends, base)
    known = sorted(base + ids + ends)
    weak = _clear([(m.start(), m.end(), "secret") for m in TOKEN.finditer(text) if _mixed(m.group())], known)
    strong = [s for s in base if s[2] != "access"]
    all_ids, all_secrets = _Parts(ids + strong_ids, scopes), _Parts(weak + strong, scopes)
    out = [s for s in ids if all_secrets.near(s, scopes, reach)]
    out += [s for s in weak if all_ids.near(s, scopes, reach)]
    out += [s for s in ends if all_ids.near(s, scopes, reach) and all_secrets.near(s, scopes, reach)]
    return out


def find(text: str, reach: int = REACH) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + linked_spans(text, base, reach), key=lambda s: (s[0], RANK[s[2]], s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col(text).alias("t"))

    def run(b):
        found = [find(t, reach) for t in b.column(1).to_pylist()]
        count = {k: [sum(s[2] == k for s in base) for base, _ in found] for k in KINDS[:3]}
        return {"doc_id": b.column(0), "n_assign": count["assign"], "n_access": count["access"],
                "n_hex": count["hex"],
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [joined(full) for _, full in found],
                "n_linked": [len(full) - len(base) for base, full in found]}

    return map_batches(rows, run, "doc_id long, n_assign long, n_access long, n_hex long, "
                       "base_sha256 string, spans string, n_linked long")


def redacted(text: str, reach: int = REACH) -> str:
    """The text with every finding replaced by ``[REDACTED]`` (overlapping findings by one)."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, z, _ in find(text, reach)[1]:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    for a, z in merged:
        out += [text[at:a], "[REDACTED]"]
        at = z
    return "".join([*out, text[at:]]) if merged else text


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars", reach: int = REACH) -> DataFrame:
    """The same rows and columns with findings replaced; ``length`` (if there) follows the text."""
    names = docs.columns
    at = names.index(text)

    def run(b):
        cols = dict(zip(names, b.columns))
        old = b.column(at).to_pylist()
        new = [None if t is None else redacted(t, reach) for t in old]
        changed = [a is not b_ and a != b_ for a, b_ in zip(old, new)]
        if any(changed):
            cols[text] = new
            if length in cols:
                cols[length] = [len(n) if c else v
                                for n, c, v in zip(new, changed, cols[length].to_pylist())]
        return {n: c if isinstance(c, pa.Array) else list(c) for n, c in cols.items()}

    return map_batches(docs, run, docs.schema)
