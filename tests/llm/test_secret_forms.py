"""Keys in the forms they are stored in: hex of either case, escaped, wrapped, encrypted."""

import base64
import json
import textwrap

import pytest

from muster.llm import secrets


def der(*parts, tag=0x30):
    body = b"".join(parts)
    width = (len(body).bit_length() + 7) // 8
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x80 + width]) + len(body).to_bytes(width, "big")
    return bytes([tag]) + size + body


def field(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


KEY = der(der(b"\x00", tag=2), *(der(bytes(range(1, 33)), tag=2) for _ in range(8)))
PBES2 = der(der(bytes.fromhex("2a864886f70d01050d"), tag=6), der(der(b"\x01\x02", tag=6), der(b"salt" * 4, tag=4)))
ENCRYPTED = der(PBES2, der(bytes(range(96)), tag=4))
PUBLIC = field(b"ssh-ed25519", bytes(range(32)))
CONTAINER = b"openssh-key-v1\x00" + field(b"none", b"none", b"") + (1).to_bytes(4, "big") + field(PUBLIC, bytes(range(160)))
B64 = base64.b64encode(KEY).decode()
LINES = "\n".join(textwrap.wrap(B64, 64))
PEM = f"-----BEGIN RSA PRIVATE KEY-----\n{LINES}\n-----END RSA PRIVATE KEY-----\n"
CIPHERED = "\n".join(textwrap.wrap(base64.b64encode(bytes(range(7, 231))).decode(), 64))
HEADED = ("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"
          f"{CIPHERED}\n-----END RSA PRIVATE KEY-----")


def part(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def token(head):
    return f"{part(head)}.{part(json.dumps({'sub': 'x'}))}.c2ln"


@pytest.mark.parametrize("kind,text,secret", [
    ("der", f"key {KEY.hex().upper()} end", KEY.hex().upper()),
    ("der", "key " + KEY.hex()[:99] + KEY.hex()[99:].upper(), KEY.hex()[:99] + KEY.hex()[99:].upper()),
    ("der", "dump:\n" + (w := "\n  ".join(textwrap.wrap(KEY.hex(), 32))) + "\nend", w),
    ("armour", json.dumps({"private_key": PEM}), json.dumps(PEM.strip())[1:-1]),
    ("armour", json.dumps(json.dumps({"private_key": PEM})), json.dumps(json.dumps(PEM.strip()))[3:-3]),
    ("armour", json.dumps({"k": PEM}).replace("/", "\\/").replace("=", "\\u003d"),
     json.dumps(PEM.strip())[1:-1].replace("/", "\\/").replace("=", "\\u003d")),
    ("armour", f"a {HEADED} b", HEADED),
    ("armour", json.dumps(HEADED), json.dumps(HEADED)[1:-1]),
    ("der", base64.b64encode(ENCRYPTED).decode(), base64.b64encode(ENCRYPTED).decode()),
    ("der", f"Some words\n{LINES}\nand more words", LINES),
    ("der", f"antidisestablishmentarianism\r\n{LINES}".replace("\n", "\r\n"), LINES.replace("\n", "\r\n")),
    ("der", json.dumps(f"x\n{LINES}\ny"), LINES.replace("\n", "\\n")),
    ("der", json.dumps(f"x\n{B64}"), B64),
    ("ssh", "\n".join(textwrap.wrap(base64.b64encode(CONTAINER).decode(), 70)) + "\nbye", "\n".join(textwrap.wrap(base64.b64encode(CONTAINER).decode(), 70))),
    ("ssh", "\n".join(textwrap.wrap(base64.b64encode(PUBLIC).decode(), 40)) + "\nbye", "\n".join(textwrap.wrap(base64.b64encode(PUBLIC).decode(), 40))),
    *[("token", f"see-the-documentation.{token(h)} ok", token(h)) for h in
      ('{"alg":"HS256"}', ' {"alg": "HS256"}', '\n{"alg":"HS256"}', '{ "alg":"HS256"}', '{\n  "typ":"JWT","alg":"none"}')],
    ("token", json.dumps(f"a\n{token('{\"alg\":\"HS256\"}')}"), token('{"alg":"HS256"}')),
])
def test_forms(kind, text, secret):
    found = secrets.scan(text)
    assert (kind, text.index(secret), text.index(secret) + len(secret)) in found
    assert secrets.scan(secrets.redact(text, found)) == []


def test_what_only_looks_like_a_key():
    digest = der(der(der(bytes.fromhex("608648016503040201"), tag=6), der(tag=5)), der(bytes(32), tag=4))
    cut = CONTAINER[:-1]
    for text in (base64.b64encode(digest).decode(), base64.b64encode(cut).decode(), LINES[:-20], LINES + "AAAA",
                 HEADED.replace("DEK-Info", "Comment"), token('{"typ":"JWT"}'), "MBAs" * 9 + "\nwords", "one.two.three " * 20):
        assert not secrets.scan(text), text
