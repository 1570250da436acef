"""The small labelled table that the personal-data tagger is trained from.

Sentences are written by hand, with a slot where a value stands; values follow from a rule.
Each slot is labelled with its kind. Sentences without a slot, and the look-alikes, hold
no personal data.
"""

from __future__ import annotations

import random

# Sentences with slots.
SENTENCES = [
    "Please write to {email} today.", "Contact: {email}", "My address is {email}, thanks", "{email}",
    "schreiben Sie an {email} bitte", "escriba a {email} por favor", "merci de contacter {email} pour la suite",
    "the and of {email} in that was", "to the {email}. Reply soon", "e-mail {email} or call {phone}",
    "Call {phone} now", "phone: {phone}", "tel. {phone}", "{phone}", "Telefon {phone} oder per Post",
    "llame al {phone} por la tarde", "appelez le {phone} demain", "of the are {phone} with inst",
    "fax {phone}, office hours only", "reach me at {phone} after six",
    "card number {card}", "pay with {card} please", "{card}", "Karte {card} ist gesperrt",
    "tarjeta {card} de su banco", "the in of {card} and the", "visa {card} expires soon",
    "charged to {card}, thank you", "was her {card} re hend.", "to {card} or {card} it is",
    "logged in from {ip}", "server {ip} is down", "{ip}", "host {ip}: timed out", "de la {ip} que el",
    "the request came from {ip}, again", "ping {ip} and {ip}", "of on {ip} and for be",
]
# Look-alikes that are no personal data, and plain text.
OTHERS = [
    "see page 12 of volume 3", "in 1999 and 2004 the", "on 2023-04-17 at 12:30:05", "version 3.12.4 was released",
    "the price is 1,299.00 today", "about 3.5 per cent of 120 people", "chapter 4.2.1 and section 7",
    "the ratio 16:9 is usual", "pages 100-120 in part 2", "we met at noon in the hall", "look at the dot on the i",
    "at the end of the day", "from the start at last", "he was at home, she at work", "born 12.03.1985 in town",
    "temperature of -12 to +5 degrees", "add 1 + 1 and get 2", "C++ and a+b are fine", "use @ for mentions",
    "this costs $40 or 35 euros", "licensed under version 2.0", "license, version 3.", "by-nc 4.0.",
    "token = \"9f8e7d6c5b4a39281706f5e4d3c2b1a0ffeeddcc\"", "commit 3f2a9c1 fixed it", "room 42, floor 5",
    "de la que el en los", "und der die in das", "le la des et une", "the and of to in is",
    "AND THE OF IN!!", "well-known and so-called things", "a | b | c | d", "### title ###", "ISBN 978-3-16 is not a phone",
    "1 2 3 4 5 6 7 8 9", "10 20 30 40", "year 2020 2021 2022", "order no. 48213 of 2019", "up to 1000000 rows",
    "at 5 dot or comma", "the dot com years", "at at at at at at", "the at the at of at", "dot dot dot dot",
    "er at at at the", "at and at", "mail at mail at mail", "mail the letter at once", "call me at noon", "card games at night",
]
FILLER = "the of in and to erth inand de la que el die und les des on was her".split()
NAMES = "anna max lea jean luis marta otto eva info sales office j.doe k.smith press".split()
SITES = "mail example web post site home corp firm".split()
ENDS = "com org net de fr es".split()


def _digits(r: random.Random, n: int) -> str:
    return "".join(str(r.randint(0, 9)) for _ in range(n))


def _value(kind: str, r: random.Random) -> str:
    if kind == "email":
        name, site, end = r.choice(NAMES), r.choice(SITES), r.choice(ENDS)
        name += r.choice(["", "", f".{r.randint(1, 99)}", f"_{r.randint(1, 99)}", f"{r.randint(1, 99)}"])
        site += r.choice(["", str(r.randint(1, 9))])
        site = r.choice([site, f"{site}.{r.choice(SITES)}"])
        return r.choice([f"{name}@{site}.{end}"] * 4 + [f"{name} at {site} dot {end}"] * 2 + [
            f"{name} [at] {site} [dot] {end}", f"{name}(at){site}.{end}",
            f"{name} (at) {site} (dot) {end}"])
    if kind == "phone":
        a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
        return r.choice([f"+{r.randint(1, 99)} ({a}) {b}-{c}"] * 3 + [
            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{r.randint(1, 99)} {a} {b} {c}", f"+{r.randint(1, 99)}-{a}-{b}-{c}",
            f"+{r.randint(1, 99)}{a}{b}{c}", f"0{a}/{b}{c}", f"{a}.{b}.{c}"])
    if kind == "card":
        four = [_digits(r, 4) for _ in range(4)]
        return r.choice(["".join(four)] * 3 + [" ".join(four), "-".join(four), _digits(r, 15), _digits(r, 13)])
    return ".".join(str(r.randint(0, 255)) for _ in range(4))


def labelled_lines(copies: int = 12, seed: int = 7) -> list[tuple[str, str]]:
    """(text, spans): spans as kind:start:end, comma-joined. Each sentence with a slot occurs
    `copies` times with other values, and others half as often, amid filler words."""
    r, out = random.Random(seed), []

    def framed(text: str) -> tuple[str, int]:
        before = " ".join(r.choices(FILLER, k=r.choice([0, 0, 1, 3])))
        after = " ".join(r.choices(FILLER, k=r.choice([0, 0, 1, 3])))
        return " ".join(x for x in (before, text, after) if x), len(before) + bool(before)

    for sentence in SENTENCES:
        for _ in range(copies):
            text, spans = "", []
            for i, part in enumerate(sentence.replace("}", "{").split("{")):
                if i % 2:
                    value = _value(part, r)
                    spans.append((part, len(text), len(text) + len(value)))
                    part = value
                text += part
            line, shift = framed(text)
            out.append((line, ",".join(f"{k}:{a + shift}:{b + shift}" for k, a, b in spans)))
    for text in OTHERS:
        for _ in range(copies // 2):
            out.append((framed(text)[0], ""))
    return out
