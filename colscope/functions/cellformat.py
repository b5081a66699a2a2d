"""Numbers as a spreadsheet shows them: a small evaluator of number formats.

A format has up to four sections (positive, negative, zero, text), each with digits (0 # ?), a decimal point, grouping, percent,
scientific notation, a fraction or literal text; colours and conditions in brackets go. Dates and times are not shown here:
they are ISO texts (see ``sources.xlsx``).
"""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

# Built-in number formats by their numbers.
BUILT_IN = {
    0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 11: "0.00E+00", 12: "# ?/?", 13: "# ??/??",
    37: "#,##0 ;(#,##0)", 38: "#,##0 ;[Red](#,##0)", 39: "#,##0.00;(#,##0.00)", 40: "#,##0.00;[Red](#,##0.00)", 48: "##0.0E+0", 49: "@",
}

_TOKEN = re.compile(r'"([^"]*)"|\\(.)|_(.)|\*(.)|\[([^\]]*)\]|(E[+-])|(General)|(.)', re.IGNORECASE | re.DOTALL)


@lru_cache(maxsize=1024)
def sections(code: str) -> tuple[tuple[tuple[str, str], ...], ...]:
    """Each section as (kind, text) tokens: lit, cond, exp, general, or the character itself."""
    out: list[list[tuple[str, str]]] = [[]]
    for quoted, escaped, space, fill, bracket, exponent, general, ch in _TOKEN.findall(code):
        if ch == ";":
            out.append([])
        elif quoted or escaped:
            out[-1].append(("lit", quoted or escaped))
        elif space:
            out[-1].append(("lit", " "))
        elif bracket:
            if m := re.fullmatch(r"\$([^-]*)(-.*)?", bracket):
                out[-1].append(("lit", m[1]))
            elif re.match("[<>=]", bracket):
                out[-1].append(("cond", bracket))
        elif exponent:
            out[-1].append(("exp", exponent[1]))
        elif general:
            out[-1].append(("general", ""))
        elif ch and not fill:
            out[-1].append((ch if ch in "0#?.,%/@" else "lit", ch))
    return tuple(map(tuple, out))


def _holds(tokens, x: Decimal) -> bool | None:
    """Whether a section's condition holds; None without one."""
    for kind, text in tokens:
        if kind == "cond":
            sign, number = re.match(r"([<>=]+)(.*)", text).groups()
            n = Decimal(number)
            return {"<": x < n, ">": x > n, "<=": x <= n, ">=": x >= n, "=": x == n, "<>": x != n}[sign]
    return None


def shown_number(text: str, code: str) -> str:
    """A number's text (as it is stored) by a number format; a text that is no number by the format's text section."""
    parts = sections(code or "General")
    try:
        x = Decimal(text)
    except ArithmeticError:
        own = next((p for p in (*parts[3:4], *parts[:1]) if any(k == "@" for k, _ in p)), None)
        return "".join(text if k == "@" else t for k, t in own) if own else text
    conditions = [_holds(p, x) for p in parts]
    if any(c is not None for c in conditions):
        at = next((i for i, c in enumerate(conditions) if c), next((i for i, c in enumerate(conditions) if c is None), 0))
        minus = x < 0
    elif len(parts) == 1:
        at, minus = 0, x < 0
    else:
        at, minus = (1 if x < 0 else 2 if x == 0 and len(parts) > 2 else 0), False
    body = _section(parts[at], abs(x))
    # A number that rounds to nothing has no sign.
    return f"-{body}" if minus and re.search("[1-9]", body) else body


def _general(x: Decimal) -> str:
    if x == 0:
        return "0"
    if Decimal("1e-9") <= x < Decimal("1e11"):
        digits = max(0, 10 - max(1, x.adjusted() + 1))
        text = f"{x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP):f}"
        return text.rstrip("0").rstrip(".") if "." in text else text
    mantissa, power = f"{x:.5E}".split("E")
    return f"{mantissa.rstrip('0').rstrip('.')}E{power[0]}{int(power[1:]):02d}"


def _section(tokens, x: Decimal) -> str:
    kinds = [k for k, _ in tokens]
    if not tokens:
        return ""
    if "general" in kinds:
        return "".join(_general(x) if k == "general" else t for k, t in tokens if k != "cond")
    if "@" in kinds:
        return "".join(_general(x) if k == "@" else t for k, t in tokens if k != "cond")
    if "/" in kinds and any(k in "0#?" for k in kinds):
        return _fraction(tokens, x)
    places = [i for i, k in enumerate(kinds) if k in "0#?"]
    if not places:
        return "".join("%" if k == "%" else t for k, t in tokens if k not in ("cond", ",", "."))
    x *= Decimal(100) ** kinds.count("%")
    power, exponent = 0, kinds.index("exp") if "exp" in kinds else None
    stop = exponent if exponent is not None else len(kinds)
    point = kinds.index(".") if "." in kinds[:stop] else None
    whole = [i for i in places if i < (point if point is not None else stop)]
    parts = [i for i in places if point is not None and point < i < stop]
    grouped = any(k == "," and whole and whole[0] < i < whole[-1] for i, k in enumerate(kinds))
    # Commas right after the last digit, or right before the point, scale by thousands.
    if exponent is None:
        after = max(i for i in places if i < stop) + 1
        while after < stop and kinds[after] == ",":
            x, after = x / 1000, after + 1
        while point and kinds[point - 1] == "," and parts:
            x, point = x / 1000, point - 1
        point = kinds.index(".") if "." in kinds[:stop] else None
    if exponent is not None and x:
        width = max(1, len(whole))
        power = x.adjusted() // width * width if width > 1 else x.adjusted()
        scaled = x.scaleb(-power).quantize(Decimal(1).scaleb(-len(parts)), ROUND_HALF_UP)
        if scaled >= 10**width:
            power += width
    x = x.scaleb(-power).quantize(Decimal(1).scaleb(-len(parts)), ROUND_HALF_UP)
    left, _, right = f"{x:f}".partition(".")
    left = "" if left == "0" else left
    need = sum(kinds[i] == "0" for i in whole)
    pads = [kinds[i] for i in whole]
    body = left.rjust(need, "0")
    if grouped:
        body = re.sub(r"(?<=\d)(?=(\d{3})+$)", ",", body)
    body = " " * sum(k == "?" for k in pads[: max(0, len(pads) - max(len(left), need))]) + body
    cut = len(parts)
    while cut and kinds[parts[cut - 1]] == "#" and right[cut - 1] == "0":
        cut -= 1
    tail = "".join(" " if kinds[i] == "?" and not right[k:].strip("0") else right[k] for k, i in enumerate(parts[:cut]))
    out, done = [], False
    for i, (k, t) in enumerate(tokens):
        if k in "0#?" and i in whole:
            out.append("" if done else body)
            done = True
        elif i == point:
            out.append(("" if done else body) + "." + tail)
            done = True
        elif k == "exp":
            own = [j for j in places if j > i]
            sign = "-" if power < 0 else "+" if t == "+" else ""
            out.append(f"E{sign}{str(abs(power)).rjust(sum(kinds[j] == '0' for j in own), '0')}")
        elif k == "%":
            out.append("%")
        elif k == "lit":
            out.append(t)
    return "".join(out)


def _fraction(tokens, x: Decimal) -> str:
    """A whole part, if the format has one, and the nearest fraction with as many digits as the format's denominator."""
    kinds = [k for k, _ in tokens]
    slash = kinds.index("/")
    after = [k for k in kinds[slash + 1 :] if k in "0#?"]
    fixed = "".join(t for k, t in tokens[slash + 1 :] if k == "lit" and t.isdigit())
    before = [i for i, k in enumerate(kinds[:slash]) if k in "0#?"]
    split = next((i for i in range(before[0], slash) if kinds[i] == "lit" and i > before[0]), None)
    whole = int(x) if split is not None and any(i < split for i in before) else 0
    rest = x - whole
    if fixed:
        bottom = int(fixed)
        top = int((rest * bottom).quantize(Decimal(1), ROUND_HALF_UP))
    else:
        from fractions import Fraction

        near = Fraction(rest).limit_denominator(10 ** len(after) - 1)
        top, bottom = near.numerator, near.denominator
    if split is not None and any(i < split for i in before) and top == bottom:
        whole, top = whole + 1, 0
    width = len(after) or len(fixed)
    part = f"{str(top).rjust(width)}/{str(bottom).ljust(width)}" if top or split is None else " " * (2 * width + 1)
    if split is None or not any(i < split for i in before):
        return part.strip() if split is None else part
    return f"{whole if whole or not top else ''} {part}".rstrip() if whole or not top else part.strip()
