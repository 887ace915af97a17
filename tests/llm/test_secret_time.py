"""Secret scans of odd and very long texts: time in proportion to length, nothing lost to a cap."""

import random
import time

import pytest

from cohortry.llm import secret_scan

KEY = "q8ZrT0vXk2Lm"
N = 1_000_000
ODD = {
    "open brackets": "key " + "(" * N, "escaped quotes": 'key = "' + '\\"' * (N // 2), "sad faces": "key " + ":(" * (N // 2), "open strings": 'key="' * (N // 5), "open triples": 'key = """a' * (N // 10),
    "escaped triples": 'key = """' + '\\"""' * (N // 4), "apostrophes": "key '" * (N // 5), "calls in calls": "key=f(" * (N // 6), "calls with strings": 'key=f("a",' * (N // 10), "named scopes": "a:{b:1," * (N // 7),
    "subscripts": "key[" * (N // 4) + "]=" * 1000, "chain of constants": "".join(f'token{i} = token{i - 1} + "x"\n' for i in range(N // 28)), "doubled constants": 'a0 = "abcdefgh1"\n' + "".join(f"a{i} = a{i - 1} + a{i - 1}\n" for i in range(1, 40_000)),
    "many secrets": f'password = "{KEY}" secret_value = other("{KEY}x")\n' * (N // 60), "backquotes": "key ` " * (N // 6), "equals": "key =" * (N // 5), "bare": "key=\n" + "b=" * (N // 2),
}


@pytest.mark.parametrize("name", sorted(ODD))
def test_odd_texts_of_a_megabyte(name):
    data = ODD[name].encode()
    small = data[: len(data) // 8]
    secret_scan.scan_text(small[:1000])
    t = time.process_time()
    secret_scan.scan_text(small)
    part = time.process_time() - t
    t = time.process_time()
    secret_scan.scan_text(data)
    whole = time.process_time() - t
    assert whole < max(6, 24 * part), (part, whole)  # eight times the text


def literals(text):
    return {text[a:b] for k, a, b, *_ in secret_scan.scan_text(text.encode()) if k == "literal"}


def test_arguments_and_subscripts_have_no_cap():
    for n in (0, 30, 70, 300, 2000):
        assert KEY in literals("signingKey = f(" + "1, " * n + f'"{KEY}")')
        assert KEY in literals("signingKey = f(" + '"other words", ' * n + f'"{KEY}")') or n and n <= secret_scan.KEY_PARTS  # joined with words it is no key
        assert KEY in literals("signingKey[" + "a+" * n + f'1] = "{KEY}"')
    assert KEY in literals(f'token = wrap(function() {{ var n = 1; var dbPass = "{KEY}"; }})')
    assert KEY in literals(f'authKey = f(x="{KEY}", y=2)') and KEY in literals(f'authKey = decode(bytes("{KEY}"))')


def test_unclosed_quotes_hide_nothing_after_them():
    assert literals(f'it\'s "so\nauthKey = "{KEY}"') == {KEY}
    assert literals(f'x = """open\nauthKey = "{KEY}"') == {KEY}
    assert literals(f"a 'b \\' c\nauthKey = '{KEY}'") == {KEY}


def plain(text):
    """One assignment a line: a reader of the plain form only."""
    out = set()
    for line in text.split("\n"):
        name, eq, value = line.partition(" = ")
        if eq and value[:1] == value[-1:] == '"' and len(value) > 2 and "\\" not in value and secret_scan.sensitive(name.encode()) and secret_scan.key_like(value[1:-1].encode(), True):
            out.add(value[1:-1])
    return out


def test_literals_against_a_plain_reader():
    rng = random.Random(5)
    for _ in range(300):
        lines = [f'{rng.choice(["dbPass", "authKey", "count", "private_key", "note"])} = "{"".join(rng.choices("abcXYZ0123456789-_/ ", k=rng.randrange(2, 24)))}"' for _ in range(rng.randrange(1, 12))]
        lines = [x for x in lines if rng.random() < 0.9]
        text = "\n".join(lines)
        base = [(a, b) for k, a, b, *_ in secret_scan.scan_text(text.encode()) if k != "literal"]
        want = {v for v in plain(text) if not any(a <= text.index(f'"{v}"') + 1 and text.index(f'"{v}"') + 1 + len(v) <= b for a, b in base)}
        assert literals(text) == want
