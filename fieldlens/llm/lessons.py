"""Made examples of wide formats: what the boosted trees learn besides the documents' own spans.

Each example is a span in a line of text, personal or not, and the part that its format lies in. Both classes
share their shapes - ten digits may be a phone or an order - so that no single check decides, and formats are dealt
into parts, so that thresholds are set on formats that the trees did not see.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

PARTS = 5

#: Words before a span that speak for or against it, in the languages of the documents.
CUES = {
    "email": ["mail", "e-mail", "email", "contact", "write to", "reach", "address", "Kontakt", "schreiben an", "courriel", "écrire à", "correo", "escriba a"],
    "ip": ["ip", "host", "server", "address", "from", "client", "Adresse", "serveur", "servidor", "login from", "node"],
    "card": ["card", "visa", "credit card", "mastercard", "paid with", "Karte", "Kreditkarte", "carte", "tarjeta", "debit", "card number"],
    "phone": ["call", "phone", "tel", "tel.", "mobile", "cell", "fax", "my number is", "reach me on", "text", "dial", "ring", "Telefon", "Rufnummer", "anrufen", "téléphone", "appelez",
              "teléfono", "llame al", "móvil", "whatsapp", "hotline"],
}
NUMBERED = ["order", "order no.", "order number", "invoice", "ref", "reference", "ticket", "case", "serial", "part", "item", "sku", "tracking", "id", "article", "isbn", "build", "batch",
            "code", "record", "row", "Bestellung", "Rechnung", "Artikel", "Auftrag", "commande", "facture", "référence", "pedido", "factura", "artículo", "No.", "Nr.", "transaction", "shipment"]
MONEY = ["$", "€", "£", "USD", "EUR", "price", "total", "sum", "amount", "Preis", "prix", "precio"]
DOMAINS = ["com", "org", "net", "de", "fr", "es", "io", "edu", "info", "co.uk", "eu", "gov", "us", "ch", "at", "it", "nl", "biz"]
PLAIN = "the of and to in is that for it as was with be by on not this have from which one all there were so out up about then them some these two may other into more only der die und das le la les et el los y".split()

Example = tuple[str, tuple[str, int, int], int, int]


def _digits(rule: random.Random, n: int, first: str = "123456789") -> str:
    return rule.choice(first) + "".join(rule.choices("0123456789", k=n - 1))


def _word(rule: random.Random) -> str:
    return "".join(rule.choices("abcdefghijklmnopqrstuvwxyz", k=rule.randint(2, 9)))


def _issued(rule: random.Random, n: int = 16) -> str:
    """Digits with a right check digit, as cards have them."""
    body = _digits(rule, n - 1, "3456")
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(body)))
    return body + str(-total % 10)


def _group(rule: random.Random) -> str:
    return f"{rule.randrange(1 << rule.choice([8, 12, 16, 16, 16])):x}"


def _grouped(digits: str, sizes: tuple[int, ...], mark: str) -> str:
    at, out = 0, []
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return mark.join(out)


def _phone_forms() -> list[Callable[[random.Random], str]]:
    shapes = [((3, 3, 4), m) for m in " -./"] + [((3, 4), " "), ((3, 7), " "), ((4, 6), "-"), ((2, 3, 2, 2), " "), ((5, 5), " "), ((2, 2, 2, 2, 2), " "), ((2, 2, 2, 2, 2), ".")]
    forms = [lambda r, s=s, m=m: _grouped(_digits(r, sum(s), "0123456789"), s, m) for s, m in shapes]
    forms += [lambda r: f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}", lambda r: f"00{_digits(r, 2)} {_digits(r, 3)} {_digits(r, 4)}", lambda r: f"0{_digits(r, 3)}/{_digits(r, 6)}",
              lambda r: f"1 ({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}", lambda r: f"00{_digits(r, 11)}", lambda r: f"1-{_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}"]
    return forms


_BARE: list[Callable[[random.Random], str]] = [lambda r: _digits(r, 10), lambda r: "0" + _digits(r, 9), lambda r: _digits(r, r.choice([7, 8, 9, 11])), lambda r: "0" + _digits(r, 10)]


def _email(rule: random.Random) -> tuple[str, list[str]]:
    name = rule.choice([_word(rule), f"{_word(rule)}.{_word(rule)}", f"{_word(rule)}{_digits(rule, 2)}", f"{_word(rule)}_{_word(rule)}", f"{_word(rule)}.{_digits(rule, 2)}"])
    return name, [*rule.choice([[_word(rule)], [_word(rule), _word(rule)], [_word(rule) + _digits(rule, 1), "example"]]), *rule.choice(DOMAINS).split(".")]


def _masked(at: str, dot: str) -> Callable[[random.Random], str]:
    def form(rule):
        name, host = _email(rule)
        return name + at + dot.join(host)

    return form


def _forms() -> dict[tuple[str, int], list[Callable[[random.Random], str]]]:
    """Makers of personal (1) and other (0) spans of each kind."""
    hexes = "0123456789abcdef"
    return {
        ("email", 1): [_masked(a, d) for a in (" (at) ", "(at)", " [at] ", "[at]", " {at} ", " (AT) ", " @ ") for d in (".", " (dot) ", "[dot]")],
        ("email", 0): [lambda r: f"{r.randint(1, 99)} @ {r.randint(0, 99)}.{r.randint(10, 99)}", lambda r: f"{_word(r)} (at) {_word(r)}.{_word(r).capitalize()}", lambda r: f"{_word(r)} @ {r.randint(1, 12)}.{r.randint(10, 59)}pm",
                       lambda r: f"{r.randint(2, 400)} (at) {r.randint(1, 9)}.{r.randint(0, 9)}x", lambda r: f"{_word(r)} [at] {_word(r)}.{r.choice(['py', 'js', 'txt', 'length', 'size', 'value'])}",
                       lambda r: f"{_word(r)}_{_word(r)} @ {_word(r)}.{r.choice(['dot', 'T', 'shape', 'sum'])}"],
        ("ip", 1): [lambda r: "[.]".join(str(r.randint(0, 255)) for _ in range(4)), lambda r: ":".join("".join(r.choices(hexes, k=r.randint(1, 4))) for _ in range(8)),
                    lambda r: "[.]".join(str(r.choice([10, 172, 192, r.randint(1, 223)]) if i == 0 else r.randint(0, 255)) for i in range(4)), lambda r: ":".join("".join(r.choices(hexes, k=4)) for _ in range(8)).upper(),
                    lambda r: "2001:db8:" + ":".join(_group(r) for _ in range(6)), lambda r: ":".join(r.choice(["0", _group(r)]) for _ in range(8)), lambda r: "fe80:0:0:0:" + ":".join(_group(r) for _ in range(4)),
                    lambda r: ":".join(_group(r) for _ in range(8)), lambda r: "[.]".join(str(r.randint(10, 255)) for _ in range(4))],
        ("ip", 0): [lambda r: "[.]".join(str(r.choice([r.randint(256, 999), r.randint(0, 99)])) for _ in range(3)) + "[.]" + str(r.randint(256, 999)), lambda r: ":".join("".join(r.choices(hexes, k=2)) for _ in range(6)),
                    lambda r: ":".join(f"{r.randint(0, 59):02d}" for _ in range(5)), lambda r: ":".join(str(r.randint(1, 9)) for _ in range(r.randint(5, 7)))],
        ("card", 1): [lambda r, m=m: _grouped(_issued(r), (4, 4, 4, 4), m) for m in (".", "/", "  ", " -", "–")] + [lambda r: _issued(r), lambda r: _grouped(_issued(r, 15), (4, 6, 5), " "), lambda r: _issued(r, 15), lambda r: _issued(r, 13)],
        ("card", 0): [lambda r, m=m: _grouped(_digits(r, 16, "0123456789"), (4, 4, 4, 4), m) for m in (".", "/", " ", "-", "")] + [lambda r: _digits(r, 15, "0123456789"), lambda r: _digits(r, 13), lambda r: _digits(r, 19), lambda r: _digits(r, 14, "01"), lambda r: _digits(r, 16, "0"),
                     lambda r: _digits(r, 17)],
        ("phone", 1): _phone_forms(),
        ("phone", 0): [lambda r: f"{r.randint(1500, 2090)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", lambda r: f"{r.randint(1, 28):02d}.{r.randint(1, 12):02d}.{r.randint(1500, 2090)}", lambda r: f"{r.randint(1, 28):02d}/{r.randint(1, 12):02d}/{r.randint(1500, 2090)}",
                       lambda r: f"{r.randint(1500, 2000)}-{r.randint(2001, 2090)}", lambda r: f"{r.randint(1, 99)}.{r.randint(0, 99)}.{r.randint(100, 9999)}", lambda r: _digits(r, r.randint(12, 18)),
                       lambda r: f"{r.randint(1, 90)}.{_digits(r, 4)} {r.randint(1, 90)}.{_digits(r, 4)}", lambda r: f"{r.randint(1, 999)} {_digits(r, 3)} {_digits(r, 3)}", lambda r: " ".join(_digits(r, 2) for _ in range(r.randint(5, 9))),
                       lambda r: f"{r.randint(1500, 2090)} {r.randint(1500, 2090)}", lambda r: "-".join([_digits(r, 3), _digits(r, 1), _digits(r, 5), _digits(r, 3), _digits(r, 1)])],
    }


def _line(rule: random.Random, before: str, span: str, after: str) -> tuple[str, int, int]:
    prose = lambda k: " ".join(rule.choices(PLAIN, k=k) if rule.random() < 0.7 else [_word(rule) for _ in range(k)])
    head = f"{prose(rule.randint(0, 7))} {before}"
    return head + span + after + " " + prose(rule.randint(0, 7)), len(head), len(head) + len(span)


def _around(rule: random.Random, kind: str, personal: int, bare: bool) -> tuple[str, str]:
    """What stands before and after a span: cues of its kind, of numbers, of money, of code and of tables, or nothing."""
    cue, numbered = rule.choice(CUES[kind]), rule.choice(NUMBERED)
    style = rule.choice([str, str.capitalize])
    spoken = style(cue) + rule.choice([" ", ": ", " is ", " at " if kind != "email" else " "])
    if personal:
        return (spoken if bare or rule.random() < 0.5 else ""), rule.choice(["", "", ".", ",", ";", ")"])
    counted = style(numbered) + rule.choice([" ", ": ", " #", "-", " = "])
    table = (f"| {_digits(rule, rule.randint(1, 9))} | ", f" | {_digits(rule, rule.randint(1, 9))} |")
    code = rule.choice([(f"{_word(rule)} = ", ";"), (f'"{_word(rule)}": ', ","), (f"{_word(rule)}=", "&"), (f'{_word(rule)} = "{_hex(rule)}', _hex(rule) + '"'), (f"{_hex(rule)}", f"{_hex(rule)}"), (f"{_word(rule)}[", "]")])
    money = rule.choice([(f"{rule.choice(MONEY)} ", ""), ("", f" {rule.choice(MONEY[:5])}"), ("", " %")])
    if kind in ("email", "ip"):
        return rule.choice(["", "", f"{_word(rule)} "]), rule.choice(["", ".", " each"])
    return rule.choice([(counted, ""), (counted, ""), table, code, money])


def _hex(rule: random.Random) -> str:
    """Ends and begins with a letter, so that the digits of a span stay its own."""
    return rule.choice("abcdef") + "".join(rule.choices("0123456789abcdef", k=rule.randint(0, 9))) + rule.choice("abcdef")


def examples(rounds: int = 60, seed: int = 5) -> Iterator[Example]:
    """(text, span, personal, part): ``rounds`` of each format."""
    rule = random.Random(seed)
    for (kind, personal), forms in _forms().items():
        for number, form in enumerate(forms):
            for _ in range(rounds):
                before, after = _around(rule, kind, personal, False) if personal or kind != "phone" or rule.random() < 0.5 else ("", "")
                text, start, end = _line(rule, before, form(rule), after)
                yield text, (kind, start, end), personal, number % PARTS
    # The same digits as phones, orders, cells and code: only what stands around tells.
    for personal in (1, 0):
        for number, form in enumerate(_BARE):
            for _ in range(4 * rounds):
                before, after = _around(rule, "phone", personal, True)
                text, start, end = _line(rule, before, form(rule), after)
                yield text, ("phone", start, end), personal, number % PARTS
    for number, form in enumerate([*_phone_forms(), *[lambda r: _issued(r)] * 2]):  # well-formed, and still an order's
        kind = "phone" if number < len(_phone_forms()) else "card"
        for _ in range(rounds // 2):
            before, after = _around(rule, kind, 0, False)
            text, start, end = _line(rule, before, form(rule), after)
            yield text, (kind, start, end), 0, number % PARTS
