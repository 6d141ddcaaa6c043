import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import secrets

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
PARTS = st.sampled_from([
    "password", "Token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abc12345", "AKIA", "AKIAABCDEFGHIJKL12", "é", "\n",
    "0123456789abcdef" * 2, "deadbeef", "ſecret=12345678", "toKen=abcdefgh", "secret=", "x",
])


def brute(text):
    raw, out = text.encode(), []
    at = lambda i: len(raw[:i].decode())
    out += [(at(m.start()), 0, at(m.end())) for m in ASSIGN.finditer(raw) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans_are_those_of_a_full_scan(text):
    assert [s for s in secrets.spans(text, secrets.automaton()) if s[1] < 3] == brute(text)


def test_checksum_decides():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = f"ghp_{body}{secrets.checksum(body)}"
    assert secrets.named(secrets.spans(f"x {good}.", secrets.automaton())) == f"checked:2:{2 + len(good)}"
    assert secrets.spans(f"x {good[:-1]}{'0' if good[-1] != '0' else '1'}.", secrets.automaton()) == []


def test_odd_rows(odd_docs, no_docs):
    rows = secrets.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert secrets.scan(no_docs).count() == 0


def test_redaction_keeps_everything_else(spark, odd_docs):
    same = secrets.redact(odd_docs)
    assert same.columns == odd_docs.columns and sorted(map(str, same.collect())) == sorted(map(str, odd_docs.collect()))
    df = spark.createDataFrame([(1, "a token: abcdefghij b", 21)], "doc_id long, text string, n_chars long")
    assert secrets.redact(df).first()[:] == (1, "a [SECRET] b", 12)
