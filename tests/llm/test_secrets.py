import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import secrets as S


def base(text):
    """The base findings by the plain rule."""
    out = [(m.start(), 0, m.end(), "assign") for m in
           re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
           if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{z}" for a, _, z, k in sorted(out)]


PARTS = ["password", "PASSWD", "token", "ſecret", "apiKey", "=", ": ", '"', "abcdefgh1", "x", "AKIA", "AKIAABCDEFGH1234",
         "deadbeef" * 4, "0123456789abcdef" * 3, " ", "\n", "é", "\n\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_spans(parts):
    text = "".join(parts)
    assert [f"{k}:{a}:{z}" for a, z, k in S.base_spans(text)] == base(text)


def test_weak_parts_need_their_complement():
    secret = "Zx81kQpLm29TuVw7yB"
    both = f"client_id = builder7\nnote {secret}\nhttps://store.example.net/v1"
    kinds = lambda t: [k for _, _, k in S.find(t)[1]]      # noqa: E731
    assert kinds(both) == ["identifier", "secret", "endpoint"]
    assert kinds(f"note {secret} https://store.example.net") == []
    assert kinds("client_id = builder7 and https://store.example.net") == []
    assert kinds(both.replace("\n", "\n\n")) == []                       # other scopes
    assert kinds("client_id = builder7 " + "word " * 200 + secret) == []  # too far
    assert kinds("user_name: bob\npassword: hunter2hunter2") == ["identifier", "assign"]


def test_links_equal_brute_force(words):
    import random
    r = random.Random(3)
    for _ in range(60):
        text = "".join(r.choice([*words[:20], " ", " ", "\n\n", "login=bob ", "Ab1" * 6 + " ", "ftp://h.example/x ",
                                 "AKIAABCDEFGH12345 ", "token: abcdefgh99 "]) for _ in range(120))
        got_base, got = S.find(text, reach=60)
        scope = lambda a: len(re.findall(r"\n[ \t]*\n", text[:a + 1])) if False else sum(
            m.start() <= a for m in re.finditer(r"\n[ \t]*\n", text))
        near = lambda x, y: scope(x[0]) == scope(y[0]) and y[0] <= x[1] + 60 and y[1] >= x[0] - 60
        free = lambda s, taken: not any(t[0] < s[1] and t[1] > s[0] for t in taken)
        ids = [x for x in ((m.start(), m.end(), "identifier") for m in S.IDENTIFIER.finditer(text)) if free(x, got_base)]
        ends = [x for x in ((m.start(), m.end(), "endpoint") for m in S.ENDPOINT.finditer(text)) if free(x, got_base)]
        weak = [x for x in ((m.start(), m.end(), "secret") for m in S.TOKEN.finditer(text)
                            if S._mixed(m.group())) if free(x, got_base + ids + ends)]
        all_ids = ids + [b for b in got_base if b[2] == "access"]
        all_secrets = weak + [b for b in got_base if b[2] != "access"]
        want = [x for x in ids if any(near(x, y) for y in all_secrets)]
        want += [x for x in weak if any(near(x, y) for y in all_ids)]
        want += [x for x in ends if any(near(x, y) for y in all_ids) and any(near(x, y) for y in all_secrets)]
        assert sorted(got) == sorted(got_base + want)


def test_scan_keeps_every_row(odd_docs, no_docs):
    rows = S.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    none = hashlib.sha256(b"").hexdigest()
    assert all(r.spans == "" and r.base_sha256 == none for r in rows)
    assert S.scan(no_docs).count() == 0


def test_redaction(spark, odd_docs):
    text = "é password=abcdefgh12 deadbeef token: " + "0123456789abcdef" * 2 + " end"
    assert S.redacted(text) == "é [REDACTED] deadbeef [REDACTED] end"
    out = S.redact(odd_docs)
    assert out.schema == odd_docs.schema
    key = lambda r: (str(r.doc_id), str(r.text))     # noqa: E731
    assert sorted(out.collect(), key=key) == sorted(odd_docs.collect(), key=key)
