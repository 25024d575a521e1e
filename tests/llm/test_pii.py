from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re

import pytest
from pyspark.sql import functions as F

from reelstar.llm import pii

KEY = "k1"


def run(documents, texts, key=KEY, accounts=True):
    rows = pii.pseudonymise(documents(texts), key, accounts=accounts).orderBy("doc_id").collect()
    return [(r.text, r.n_replaced, r.kinds) for r in rows]


def slow_feistel(x, a, b, tweak, key=KEY):
    key = "pseudonym-key-" + hashlib.sha256(key.encode()).hexdigest()
    left, right = divmod(x, b)
    for i in range(1, pii.ROUNDS + 1):
        half = right if i % 2 else left
        add = int(hashlib.sha256(f"{key}|{tweak}|{i}|{half}".encode()).hexdigest()[:14], 16)
        if i % 2:
            left = (left + add) % a
        else:
            right = (right + add) % b
    return left * b + right


def slow_permuted(text, alphabet, kind):
    """A string permuted among all of its length and alphabet."""
    out, size, k = "", pii.CHUNK[alphabet], len(alphabet)
    for j in range(-(-len(text) // size)):
        c = text[j * size:(j + 1) * size]
        v = 0
        for d in c:
            v = v * k + alphabet.index(d)
        v = slow_feistel(v, k ** (len(c) // 2), k ** (len(c) - len(c) // 2), f"{kind},{j},{len(text)}")
        back = ""
        for _ in c:
            back, v = alphabet[v % k] + back, v // k
        out += back
    return out


def slow_iban(text):
    """An account number by its parts; also whether check digits agree."""
    plain = text.replace(" ", "")
    number = lambda t: int("".join(str(int(c, 36)) for c in t))
    d = iter(slow_permuted("".join(c for c in plain[4:] if c.isdigit()), pii.DIGITS, "iban-d"))
    a = iter(slow_permuted("".join(c for c in plain[4:] if c.isalpha()).lower(), pii.LETTERS, "iban-l").upper())
    body = "".join(next(d) if c.isdigit() else next(a) for c in plain[4:])
    new = iter(f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")
    return "".join(c if c == " " else next(new) for c in text), number(plain[4:] + plain[:4]) % 97 == 1


def luhn(digits):
    return sum((d * 2 - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))) % 10


TEXT = ('call +1 (017) 555-7713, mail Sch.34@mail7.example.com; card 4111 1111 1111 1111 (4111111111111111) ip 152.143.123.131 '
        'ssn 078-05-1120 born 2004-02-29 or 02/29/2004 or 29.02.2004 token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"!!')


def test_formats_and_links(documents):
    (text, n, kinds), (again, _, _) = run(documents, [TEXT, "x " + TEXT.upper()])
    assert n == 10 and kinds == ["phone", "email", "card", "card", "ip", "ssn", "date", "date", "date", "hex"]
    shape = lambda t: re.sub(r"\d{1,3}(?:\.\d{1,3}){3}", "ip", re.sub(r"[0-9a-f]{40}", "hex", t))
    assert re.sub(r"\d", "9", re.sub("mail .*@", "", shape(text))) == re.sub(r"\d", "9", re.sub("mail .*@", "", shape(TEXT)))
    assert again == "x " + text.upper()
    cards = re.findall(r"card ([\d ]+) \((\d+)\)", text)[0]
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111" and luhn(cards[1]) == 0
    dates = re.search(r"born (\S+) or (\S+) or (\S+) ", text).groups()
    day = dt.date.fromisoformat(dates[0])
    assert dates == (day.isoformat(), day.strftime("%m/%d/%Y"), day.strftime("%d.%m.%Y"))
    assert "Sch.34" not in text and re.search(r"mail [A-Z][a-z]{2}\.\d\d@mail7\.example\.com;", text)
    assert run(documents, [TEXT], "k2")[0][0] != text


def test_values_match_a_plain_feistel(documents):
    ips = [f"{i}.{j}.0.{255 - i}" for i in (0, 1, 255) for j in (0, 7)]
    days = [dt.date(1900, 1, 1), dt.date(2000, 2, 29), dt.date(2100, 1, 1)]
    got = run(documents, [*ips, *map(str, days), "001-01-0001", "899-99-9999", "667-01-0001"])
    want = []
    for ip in ips:
        v = slow_feistel(int.from_bytes(map(int, ip.split("."))), 65536, 65536, "ip")
        want.append(".".join(map(str, v.to_bytes(4))))
    for d in days:
        want.append(str(dt.date(1900, 1, 1) + dt.timedelta(slow_feistel((d - dt.date(1900, 1, 1)).days, *pii.DAYS, "date"))))
    assert [g[0] for g in got[:len(want)]] == want
    for text, n, kinds in got[len(want):]:
        area, group, serial = map(int, text.split("-"))
        assert kinds == ["ssn"] and 1 <= area <= 899 and area != 666 and group > 0 and serial > 0


def test_a_permutation(documents):
    # every two-digit local part goes to another one
    got = [t for t, _, _ in run(documents, [f"{i:02d}@a.bc" for i in range(100)])]
    assert sorted(got) == [f"{i:02d}@a.bc" for i in range(100)]


def test_accounts_keep_their_remainder(documents):
    numbers = ["9807915762804490", "4785380592391135", "1234567890123", "1234567890123456789", "0000000000000000"]
    for before, (after, n, kinds) in zip(numbers, run(documents, numbers)):
        assert len(after) == len(before) and luhn(after) == luhn(before) and after != before
        assert (n, kinds) == (1, ["card" if luhn(before) == 0 else "account"])


def test_unvalidated_numbers_only_on_demand(documents):
    stamp, card = "1699999999999", "4111111111111111"
    (same, n, kinds), (moved, _, found) = run(documents, [stamp, card], accounts=False)
    assert (same, n, kinds) == (stamp, 0, []) and moved != card and luhn(moved) == 0 and found == ["card"]
    assert run(documents, [stamp])[0][2] == ["account"]


def test_every_kind_against_plain_code(documents):
    ten = "4155552671"
    moved = slow_permuted(ten, pii.DIGITS, "phone")
    card = "411111111111111"
    body = slow_permuted(card, pii.DIGITS, "card")
    last = next(d for d in "0123456789" if luhn(body + d) == 0)
    secret, decimal = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "12345678901234567890123456789012"
    want = {
        "(415) 555-2671": (f"({moved[:3]}) {moved[3:6]}-{moved[6:]}", "phone"),
        "415-555-2671": (f"{moved[:3]}-{moved[3:6]}-{moved[6:]}", "phone"),
        "415.555.2671": (f"{moved[:3]}.{moved[3:6]}.{moved[6:]}", "phone"),
        "+1 415 555 2671": (f"+1 {moved[:3]} {moved[3:6]} {moved[6:]}", "phone"),
        card + "1": (body + last, "card"),
        secret: (slow_permuted(secret, pii.HEX, "hex"), "hex"),
        secret.upper(): (slow_permuted(secret, pii.HEX, "hex").upper(), "hex"),
        decimal: (slow_permuted(decimal, pii.DIGITS, "hex-d"), "hex"),
        "Ab.9@x.org": (None, "email"),
    }
    for iban in ("DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO9386011117947"):
        new, valid = slow_iban(iban)
        assert valid and slow_iban(new)[1]
        want[iban] = (new, "iban")
    for address in ("2001:db8::8a2e:370:7334", "2001:0DB8:0:0:0:8A2E:370:7334", "fe80::1"):
        full = "".join(f"{int(g, 16):04x}" for g in ipaddress.ip_address(address).exploded.split(":"))
        moved6 = slow_permuted(full, pii.HEX, "ip6")
        text = ":".join(f"{int(moved6[i:i + 4], 16):x}" for i in range(0, 32, 4))
        want[address] = (text.upper() if "DB8" in address else text, "ip6")
    local = slow_permuted("ab", pii.LETTERS, "email-l")
    want["Ab.9@x.org"] = (f"{local[0].upper()}{local[1]}.{slow_permuted('9', pii.DIGITS, 'email-d')}@x.org", "email")
    got = run(documents, list(want), accounts=False)
    assert [(t, k) for t, _, k in got] == [(t, [k]) for t, k in want.values()]
    assert len({ipaddress.ip_address(got[i][0].lower()) for i, k in enumerate(want) if "db8" in k.lower()}) == 1


def test_plans_do_not_show_the_key(documents, capsys):
    df = pii.pseudonymise(documents([TEXT]), "verysecretkey")
    df.explain("extended")
    shown = capsys.readouterr().out
    assert "redacted" in shown and "verysecretkey" not in shown
    assert hashlib.sha256(b"verysecretkey").hexdigest() not in shown


@pytest.mark.parametrize("text", ["115-555-2671 (415) 155-2671 4155552671 415-555-26715", "DE88 3704 0044 0532 0130 00 XY12 ABCD",
                                  "std::abc::x dead::beef 12:30:45 1:2:3:4:5:6:7 1::2::3 a::", "", None, "nothing", "4.0. 1.2.3 256.1.1.1 1.2.3.4.5", "2003-02-29 2101-01-01 1899-12-31 13/13/2000",
                                  "666-12-1234 900-11-1111 000-11-1111 123-00-1234", "a@b @ x@", "123456789012 12345678901234567890"])
def test_left_alone(documents, text):
    assert run(documents, [text]) == [(text, 0, [])]


def test_long_text_and_neighbours(documents):
    long = "z" * 300_000 + " 1" * 50_000 + " 4111111111111111 4111111111111111 " + "%" * 100_000 + "x.9@y.zz"
    text, n, kinds = run(documents, [long])[0]
    assert n == 3 and len(text) == len(long)
    a, b = text[400_001:400_034].split()
    assert a == b


def test_rows_and_columns(documents):
    df = documents([(1, TEXT), (1, TEXT), (None, None)]).withColumn("_m", F.lit(1)).withColumn("_f", F.lit(1)).withColumn("kinds", F.lit(2))
    rows = pii.pseudonymise(df, KEY).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]
    assert pii.pseudonymise(documents([]), KEY).collect() == []
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymise(df, "it's")
