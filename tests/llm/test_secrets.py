"""Secrets that are longer, or hold more, than the usual ones."""

import re
import time

from dayloom.llm.secret_scan import RULES, Scanner, redact


def scan(text):
    return Scanner(RULES).scan([text])[0]


def key(kind, body, end=None):
    return f"-----BEGIN {kind}PRIVATE KEY-----\n{body}\n-----END {kind if end is None else end}PRIVATE KEY-----"


def test_keys_whose_body_has_hyphens():
    body = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\nMIIEpAIBAAKCAQEA+w==\n-----BEGIN CERTIFICATE-----\nMIIB\n-----END CERTIFICATE-----"
    for secret in (key("RSA ", body), key("", "------\nMIIE-----"), key("EC ", "ab", "")):
        text = f"before {secret} between {secret} after"
        assert [(a, b) for k, a, b in scan(text) if k == "private_key"] == [(7, 7 + len(secret)), (16 + len(secret), 16 + 2 * len(secret))]
        assert redact(text, scan(text)) == "before [REDACTED] between [REDACTED] after"


def test_a_begin_line_without_an_end_takes_itself_only():
    begin, whole = "-----BEGIN RSA PRIVATE KEY-----", key("RSA ", "MIIE")
    text = f"The line {begin} starts a key - as in {whole}."
    assert redact(text, scan(text)) == "The line [REDACTED] starts a key - as in [REDACTED]."
    start = time.perf_counter()
    assert len(scan(f"{begin} - x\n" * 30_000)) == 30_000
    assert time.perf_counter() - start < 20


def test_long_logins():
    for user, word in (("x", "q-" * 46 + "q"), ("u" * 200, "p%40" * 500), ("u", "abc")):
        text = f"https://{user}:{word}@host/path"
        assert ("url_login", 5, 5 + len(f"://{user}:{word}@")) in scan(text)
        assert word not in redact(text, scan(text))
    assert not scan("https://u:ab@host https://host:8080/a@b")


def test_web_tokens_in_linear_time():
    rule = next(r for r in RULES if r.kind == "web_token")
    token = "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh1"
    text = token + " " + "eyJ" * 350_000 + " " + token
    begun = time.time()
    found = [m.span() for m in re.finditer(rule.pattern, text)]
    assert time.time() - begun < 2
    assert found == [(0, len(token)), (len(text) - len(token), len(text))]
