"""Reading one instant out of text in many notations (plain Python, run in Arrow batches)."""

from __future__ import annotations

import re
import unicodedata
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

ORDERS = ("dmy", "mdy", "ymd")
# Names of months by their first letters, in English, German, French, Spanish and Russian.
MONTHS = {
    1: ["jan", "jän", "ene", "янв"], 2: ["feb", "fév", "fev", "фев"], 3: ["mar", "mär", "mrz", "мар"], 4: ["apr", "avr", "abr", "апр"],
    5: ["may", "mai", "май", "мая"], 6: ["jun", "juin", "июн"], 7: ["jul", "juil", "июл"], 8: ["aug", "aoû", "aou", "ago", "авг"],
    9: ["sep", "set", "сен"], 10: ["oct", "okt", "окт"], 11: ["nov", "ноя"], 12: ["dec", "dez", "déc", "dic", "дек"],
}
_MONTH = {x: m for m, names in MONTHS.items() for x in names}
ERAS = {"令和": 2018, "R": 2018, "平成": 1988, "H": 1988}  # fixed values: the year before an era's first

_TIME = r"(?P<h>\d{1,2})\s*[:hH時]\s*(?P<mi>\d{2})分?(?::(?P<s>\d{2})(?:[.,]\d+)?)?\s*(?P<ap>[AaPp]\.?\s?[Mm](?![A-Za-z])\.?)?(?:\s*Uhr)?"
_ZONE = r"(?P<z>Z|z|(?:UTC|GMT|utc|gmt)?[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]+(?:/[A-Za-z_+-]+)+|[A-Za-z]{1,5})"
_DAY = r"(?:[^\W\d_]+\.?,?\s+)?"
_AT = r"(?:,?\s*(?:à|um|at|a las|в)?\s*" + _TIME + r")?"
_FORMS = [
    ("iso", r"(?P<y>\d{4})[-/](?P<m>\d{1,2})[-/](?P<d>\d{1,2})(?:(?:[Tt]|\s+)" + _TIME + r")?(?:\s*" + _ZONE + r")?(?:\s*\[[^\]]*\])?"),
    ("basic", r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?:[Tt]?(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})?(?:[.,]\d+)?)?\s*" + _ZONE + "?"),
    ("named", _DAY + r"(?P<d>\d{1,2})(?:\.|er|st|nd|rd|th)?(?:\s+|-)(?:de\s+)?(?P<mon>[^\W\d_]+)\.?(?:\s+|-)(?:de\s+)?(?P<y>\d{4}|\d{2})(?:\s*г\.?)?" + _AT + r"(?:\s*" + _ZONE + ")?"),
    ("first", _DAY + r"(?P<mon>[^\W\d_]+)\.?\s+(?P<d>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<y>\d{4})" + _AT + r"(?:\s*" + _ZONE + ")?"),
    ("ctime", r"[^\W\d_]+\s+(?P<mon>[^\W\d_]+)\s+(?P<d>\d{1,2})\s+" + _TIME + r"\s+(?:" + _ZONE + r"\s+)?(?P<y>\d{4})"),
    ("number", r"(?P<a>\d{1,2})(?P<sep>[./-])(?P<b>\d{1,2})(?P=sep)(?P<y>\d{4}|\d{2})" + _AT + r"(?:\s*" + _ZONE + ")?"),
    ("kanji", r"(?:(?P<y>\d{4})|(?P<era>令和|平成|R|H)(?P<ey>\d{1,2}|元))年\s*(?P<m>\d{1,2})月\s*(?P<d>\d{1,2})日(?:\([^)]*\))?\s*(?:(?P<half>午前|午後)?\s*" + _TIME + r")?(?:\s*" + _ZONE + ")?"),
    ("era", r"(?P<era>令和|平成|R|H)(?P<ey>\d{1,2})[./-](?P<m>\d{1,2})[./-](?P<d>\d{1,2})(?:\s+" + _TIME + r")?(?:\s*" + _ZONE + ")?"),
]
FORMS = [(k, re.compile(p)) for k, p in _FORMS]
EPOCH = datetime(1970, 1, 1)
UTC = timezone.utc


_ZONES: dict[str, ZoneInfo | None] = {}


def _zone(name: str) -> ZoneInfo | None:
    if name not in _ZONES:
        if len(_ZONES) > 1000:
            _ZONES.clear()
        try:
            _ZONES[name] = ZoneInfo(name)
        except Exception:
            _ZONES[name] = None
    return _ZONES[name]


def wall_epoch(at: datetime, zone: str) -> int | None:
    """Whole seconds of a wall time: the earlier instant of a repeated one, the offset before the change of a skipped one."""
    z = _zone(zone)
    return None if z is None else int((at - EPOCH).total_seconds()) - int(z.utcoffset(at).total_seconds())


def offset_seconds(z: str, codes: dict[str, int]) -> int | None:
    if (m := re.fullmatch(r"(?:UTC|GMT)?([+-])(\d{1,2}):?(\d{2})?", z.upper())) is not None:
        n = int(m[2]) * 3600 + int(m[3] or 0) * 60
        return n if m[1] == "+" else -n
    c = codes.get(z.upper())
    return None if c is None else c * 60


def _calendar(m: re.Match, order: str) -> datetime | None:
    g = m.groupdict()
    if g.get("era"):
        y = ERAS[g["era"]] + (1 if g["ey"] == "元" else int(g["ey"]))
    else:
        y = int(g["y"]) + (2000 if len(g["y"]) == 2 else 0)
    if g.get("mon"):
        name = g["mon"].lower()
        mo = next((v for n in (4, 3) if (v := _MONTH.get(name[:n]))), None)
        if mo is None:
            return None
        d = int(g["d"])
    elif g.get("a"):
        mo, d = (int(g["a"]), int(g["b"])) if order == "mdy" else (int(g["b"]), int(g["a"]))
    else:
        mo, d = int(g["m"]), int(g["d"])
    h, mi, s = int(g.get("h") or 0), int(g.get("mi") or 0), int(g.get("s") or 0)
    half = (g.get("ap") or "")[:1].lower()
    if half or g.get("half"):
        if half and not 1 <= h <= 12:
            return None
        late = half == "p" or g.get("half") == "午後"
        h = h % 12 + 12 * late
    try:
        return datetime(y, mo, d, h, mi, s)
    except ValueError:
        return None


def tidy(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).split())


def _match(x: str) -> tuple[str, re.Match | int | None]:
    """The notation of a tidied text with what matched, or the seconds that it is."""
    if not x:
        return "none", None
    if x.isdigit() and len(x) in (10, 13, 16, 19):
        return "epoch", int(x) // 10 ** (len(x) - 10)
    if re.fullmatch(r"\d{10}\.\d+", x):
        return "epoch", int(x.split(".")[0])
    for form, p in FORMS:
        if (m := p.fullmatch(x)) is not None:
            return form, m
    return "words", None


def _zone_of(m: re.Match) -> str | None:
    z = m.groupdict().get("z")
    return None if not z or z.lower() == "г" else z


def _instant(at: datetime | None, z: str | None, zone: str | None, codes: dict[str, int]) -> int | None:
    if at is None:
        return None
    if not z:
        return wall_epoch(at, zone) if zone else None
    if "/" in z:
        return wall_epoch(at, z)
    off = 0 if z in "Zz" else offset_seconds(z, codes)
    return None if off is None else int((at - EPOCH).total_seconds()) - off


def read(text: str | None, order: str, zone: str | None, codes: dict[str, int]) -> tuple[str, int | None]:
    """(form, whole seconds since 1970 UTC or None) of a text, all-number dates read in the given order, times without
    offset or zone being wall time of `zone`. Words, impossible dates and unknown zones name no instant."""
    form, m = _match(tidy(text) if text else "")
    return (form, _instant(_calendar(m, order), _zone_of(m), zone, codes)) if isinstance(m, re.Match) else (form, m)


def ways(text: str | None, zone: str | None, codes: dict[str, int]) -> tuple[str, bool, tuple[int | None, ...]]:
    """(form, whether it names its offset, the instants by each format): day first and month first, each as wall time of
    `zone` and of UTC. Formats that don't differ for a text have one instant; without a zone UTC isn't read either."""
    form, m = _match(tidy(text) if text else "")
    if not isinstance(m, re.Match):
        return form, True, (m,) * 4
    z = _zone_of(m)
    out: list[int | None] = []
    for order in ("dmy", "mdy") if form == "number" else ("dmy",):
        at = _calendar(m, order)
        own = _instant(at, z, zone, codes)
        out += [own, own if z or not zone else _instant(at, z, "UTC", codes)]
    return form, bool(z), tuple(out * 2)[:4]


def day_of(text: str | None, hours: int = 9) -> int | None:
    """Days since 1970 of a date, or of an instant's date at that offset; wall time without an offset is of that offset."""
    x = tidy(text) if text else ""
    for form, p in FORMS[:2]:
        if (m := p.fullmatch(x)) is not None and (at := _calendar(m, "ymd")) is not None:
            z = m.groupdict().get("z")
            if z:
                off = 0 if z in "Zz" else offset_seconds(z, {"UTC": 0, "GMT": 0, "JST": 540})
                if off is None:
                    return None
                at = at - timedelta(seconds=off) + timedelta(hours=hours)
            return (at.date() - date(1970, 1, 1)).days
    return None
