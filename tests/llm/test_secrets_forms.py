"""Forms in which keys are written: escaped, wrapped, inside longer runs, encoded twice."""

import base64
import json
import random
import time

import pytest
from test_secrets import B64, PEM, PKCS8, RSA, SEC1, SSH, tlv

from tidemark.llm import secrets


def added(text):
    return [s for s in secrets.spans(text) if s[0] not in secrets.KINDS[:3]]


def wrapped(text, by, width=64):
    return by.join(text[k : k + width] for k in range(0, len(text), width))


@pytest.mark.parametrize("key", [PEM("PRIVATE KEY", PKCS8), PEM("RSA PRIVATE KEY", RSA), PEM("OPENSSH PRIVATE KEY", SSH)])
@pytest.mark.parametrize("times", [1, 2])
def test_pem_with_escaped_line_breaks(key, times):
    text = key
    for _ in range(times):
        text = json.dumps({"private_key": text + "\n", "b": 1})
    at = text.index("-----BEGIN")
    last = text.rindex("PRIVATE KEY-----") + len("PRIVATE KEY-----")
    assert added(text) == [("pem", at, last)]


@pytest.mark.parametrize("data", [RSA, PKCS8, SEC1, SSH])
@pytest.mark.parametrize("by", ["\n", "\r\n", "\\n", "\n    "])
@pytest.mark.parametrize("after", ["", "\nand then prose", " after"])
def test_bare_der_over_lines(data, by, after):
    key = wrapped(B64(data), by)
    assert added(f"é key: {key}{after}") == [("der", 7, 7 + len(key))]


def test_hex_over_lines():
    key = wrapped(PKCS8.hex().upper(), "\n")
    assert added(f"x {key}\n") == [("der", 2, 2 + len(key))]


@pytest.mark.parametrize("before", ["path/", "key_", "a-", "MIIabc/", "30_", "x" * 60 + "/"])
@pytest.mark.parametrize("data", [RSA, PKCS8, SSH])
def test_starts_inside_a_run(before, data):
    key = B64(data)
    assert added(before + key) == [("der", len(before), len(before) + len(key))]


@pytest.mark.parametrize("before", ["0x", "0X", "key_", "ff/"])
def test_hex_starts_inside_a_run(before):
    key = PKCS8.hex().upper()
    assert added(before + key) == [("der", len(before), len(before) + len(key))]


@pytest.mark.parametrize("by", ["", "\n"])
def test_pem_encoded_once_more(by):
    pem = PEM("RSA PRIVATE KEY", RSA) + "\n"
    for inner in (pem, pem + "-----BEGIN CERTIFICATE-----\nMIIB\n-----END CERTIFICATE-----\n"):
        key = base64.b64encode(inner.encode()).decode()
        key = wrapped(key, "\n", 76) if by else key
        assert added("data: " + key) == [("der", 6, 6 + len(key))]


@pytest.mark.parametrize("text", [wrapped(B64(RSA[:-4]), "\n"), "path/" + B64(RSA + b"\0"), "0x" + PKCS8.hex().upper()[:-2], B64(b"-----BEGIN CERTIFICATE-----\nMIIB\n-----END CERTIFICATE-----\n"), "MEDIUM\n" * 50])
def test_what_only_looks_like_a_key_is_left(text):
    assert not added(text)


def test_long_runs_take_no_square_of_time():
    data = base64.b64encode(random.Random(1).randbytes(1_500_000)).decode()
    began = time.process_time()
    assert not added(data)
    assert time.process_time() - began < 20


def _token(header, claims='{"sub":"1"}'):
    part = lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("=")
    return f"{part(header)}.{part(claims)}.c2lnbmF0dXJl"


def test_tokens_in_runs_and_with_blanks():
    plain, blank, line = _token('{"alg":"HS256"}'), _token('{ "alg":"HS256"}'), _token('{\n "alg":"none"}')
    for token in (plain, blank, line):
        for before, after in (("", ""), ("x_", " "), ("a.", ""), ("v1.eyJ.", "."), ("Bearer ", "\n")):
            text = before + token + after
            found = [x for x in added(text) if x[0] == "jwt"]
            assert [text[a:b] for _, a, b in found] == [token], (before, token)
    assert not [x for x in added(_token('{"typ":"x"}')) if x[0] == "jwt"]


def test_inner_keys_are_parsed():
    filler = b"not a key at all, only filler text of some length here and there"
    alg = lambda oid: tlv(0x30, tlv(6, bytes.fromhex(oid)) + tlv(5, b""))
    shell = lambda oid, key: tlv(0x30, tlv(2, b"\0") + alg(oid) + tlv(4, key))
    rsa, ec, ed = "2a864886f70d010101", "2a8648ce3d0201", "2b6570"
    own = tlv(0x30, tlv(2, b"\1") + tlv(4, bytes(range(32))))
    for good in (shell(rsa, RSA), shell(ec, own), shell(ed, tlv(4, bytes(range(32)))), tlv(0x30, alg("2a864886f70d01050d") + tlv(4, bytes(range(48))))):
        assert [k for k, *_ in added("x " + B64(good) + " y")] == ["der"]
    for bad in (shell(rsa, filler), shell(ec, filler), shell(ed, filler), shell("2a0304", RSA), shell(rsa, own), tlv(0x30, alg(rsa) + tlv(4, b"zzz" * 20))):
        assert not added("x " + B64(bad) + " y")


def test_dotless_and_dotted_runs_take_no_square_of_time():
    import time

    for text in ("eyJ" * 1_700_000, "eyJ." * 100_000, "ey" * 2_500_000 + ".a.b"):
        began = time.time()
        added(text)
        assert time.time() - began < 30
