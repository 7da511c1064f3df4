"""Encoded keys: where they are found, what is no key, and that odd texts take no longer than others."""

import base64
import json
import os
import random
import struct
import time

import pytest

from trolley.llm import key_structures as keys
from trolley.llm import secrets_scan


def tlv(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([128 + len(b := n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + b
    return bytes([tag]) + size + content


def key_of(n):
    rnd = random.Random(n)
    number = lambda k: tlv(2, b"\x01" + rnd.randbytes(k))
    return tlv(0x30, number(0) + tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(4, tlv(0x30, number(n) + number(n))))


def field(data):
    return struct.pack(">I", len(data)) + data


PUBLIC = field(b"ssh-ed25519") + field(bytes(range(32)))
PRIVATE = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + struct.pack(">I", 1) + field(PUBLIC) + field(os.urandom(96))


def found(text):
    return [(kind, text[a:b]) for kind, a, b in secrets_scan.spans_of(text) if kind not in secrets_scan.BASE]


def b64(data):
    return base64.b64encode(data).decode()


def jwt(header, claims='{"sub":1}', signature="c2ln"):
    part = lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("=")
    return f"{part(header)}.{part(claims)}.{signature}"


@pytest.mark.parametrize("n", [1, 2, 3, 50, 128, 300, 70_000])
@pytest.mark.parametrize("before", ["", "path/", "a/b+", "M", "MA", "x: ", "word\n"])
def test_der_keys_are_found_wherever_they_start(n, before):
    text = b64(key_of(n))
    assert found(f"{before}{text} x") == [("der", text)]
    lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    assert found(f"{before}{lines}\nThe end of it") in ([("der", lines)], [("der", lines + "\n")]) or "=" not in text
    assert ("der", lines) in found(f"{before}{lines}\n\nx")


@pytest.mark.parametrize("key", [PUBLIC, PRIVATE])
def test_ssh_keys(key):
    text = b64(key)
    assert found(f"ssh-ed25519 {text} me@host") == [("ssh", text)]
    assert ("ssh", text) in found(f"dir/{text}")
    assert found(key.hex()) == [("ssh", key.hex())]
    assert found(b64(key[:-1])) == [] == found(b64(key + b"\0\0\0"))


def test_what_only_begins_like_a_key_is_none():
    assert found(b64(b"openssh-key-v1\0" + b"some prose that follows it, and more of it")) == []
    assert found(b64(key_of(50)[:-1])) == [] and found(b64(key_of(50) + b"\1")) == []
    assert found(b64(tlv(0x30, tlv(4, b"x" * 40)))) == []  # a single member
    block = "-----BEGIN PGP MESSAGE-----\nVersion: 1\n\nhQEMA1234567890abcd\n=abcd\n-----END PGP MESSAGE-----"
    assert found(block) == []
    assert found(jwt('{"alg":"HS256"}', signature="")) == []
    assert found(jwt('{"alg":"none"}', signature="") + " x") == [("jwt", jwt('{"alg":"none"}', signature=""))]


def test_frames():
    text = b64(key_of(90))
    block = f"-----BEGIN RSA PRIVATE KEY-----\r\n{text[:64]}\r\n{text[64:]}\r\n-----END RSA PRIVATE KEY-----"
    assert found(f"a {block} b") == [("der", block)]
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"
    secret = f"-----BEGIN EC PRIVATE KEY-----\n{head}{b64(bytes(range(64)))}\n-----END EC PRIVATE KEY-----"
    assert found(secret) == [("pem", secret)]
    assert found(secret.replace(b64(bytes(range(64))), b64(bytes(range(63))))) == []
    assert found(f"-----BEGIN A-----\n-----BEGIN B-----\n{text}\n-----END B-----")[0][0] == "der"
    assert [k for k, _ in found(f"-----BEGIN A-----\n{text}\n-----END B-----")] == ["der"]  # the bare key


def test_nesting_and_lengths_have_no_limit():
    data = tlv(2, b"\1") + tlv(2, b"\2")
    for _ in range(3000):
        data = tlv(0x30, data + tlv(5, b""))
    assert keys.is_der(data) and found(b64(data)) == [("der", b64(data))]
    assert not keys.is_der(data[:-1] + b"\1")


def test_brute_force_agrees_on_short_runs():
    rnd = random.Random(3)
    for _ in range(300):
        key = key_of(rnd.randint(1, 9))
        if rnd.random() < 0.4:
            key = bytearray(key)
            key[rnd.randrange(len(key))] ^= 1 << rnd.randrange(8)
        run = "".join(rnd.choices("MAPx/9", k=rnd.randint(0, 9))) + b64(bytes(key)).rstrip("=")
        expected, over = [], 0
        for start in range(len(run)):
            data = keys.decode64(run[start:])
            if start >= over and data is not None and keys.is_der(data):
                expected.append(("der", start, len(run)))
                over = len(run)
        assert list(keys.keys_in(run)) == expected


MB = 1 << 20
ODD = {
    "line breaks": "-----BEGIN A-----" + "\n" * MB,
    "blank lines": "-----BEGIN A-----\n" + " \n" * (MB // 2) + "-----END A-----",
    "markers": "-----BEGIN A-----\n" * (MB // 18),
    "dashes": "-" * MB,
    "dashed parts": "-".join(["eyJ"] * (MB // 4)) + ".eyJ.x",
    "dotted parts": ".".join(["eyJhbGciOiJ"] * (MB // 12)),
    "open objects": "eyJh" * (MB // 4) + ".eyJh.x",
    "open strings": "-eyJ" + "h" * MB + ".eyJh.x",
    "blanks in base64": "-".join(["CgoK"] * (MB // 5)) + "." + "CgoK" * 1000 + ".x",
    "letters M": "M" * MB,
    "letters MA": "MA" * (MB // 2),
    "letters A": "A" * MB,
    "names": b64(field(b"ssh-rsa") * (MB // 16)),
    "words on lines": "word\n" * (MB // 5),
    "hex": "30" * (MB // 2),
    "headers": "-----BEGIN A-----\n" + "A: b\n" * (MB // 5) + "-----END A-----",
    "nested": b64(b"\x30\x84\x00\x00\x00\x00" * (MB // 8)),
}


@pytest.mark.parametrize("name", ODD)
def test_odd_texts_take_no_longer_than_others(name):
    began = time.process_time()
    secrets_scan.spans_of(ODD[name])
    assert time.process_time() - began < 4  # seconds of this process, whatever else runs


def test_nested_values_that_break_at_the_end():
    data = b"\1\1"
    for _ in range(20_000):
        data = tlv(0x30, tlv(2, b"\1") + data)
    began = time.process_time()
    assert found(b64(data)) == []
    assert time.process_time() - began < 8
    assert json.loads('{"a":1}') == {"a": 1}
