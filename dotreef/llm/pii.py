"""Personal data in whole texts, plain or disguised, as spans of the original text.

Plain forms are four fixed patterns. Disguised ones go through a chain of transducers: look-alike letters and digits become
ASCII, invisible characters vanish, ``(at)``, ``[dot]``, `` at `` and `` dot `` become their signs, spelled digits become digits. Each transducer
hands on where every character came from, so a span of the normalised text is mapped back to code points of the source.

NULL and empty text: no spans. Repeated rows are searched on their own, other columns are not read. The search is linear in
the text for any text. A disguised span that cuts into a plain one of its kind is left out; one that holds it whole is given beside it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_document, texts, tune

KINDS = ("email", "ip", "card", "phone")

# The fixed patterns. Possessive repeats and a look-behind keep a failing start from being tried again at each character;
# which matches are found stays the same, as a run of digits can only match from its first one.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def _ip(m: re.Match) -> bool:
    return all(len(p) < 4 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split(".")))


def _card(m: re.Match) -> bool:
    digits = _NO_DIGIT.sub("", m[0])
    return 14 <= len(digits) <= 19 and luhn(digits)


def _phone(m: re.Match) -> bool:
    return 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15


_NUMERIC = (("ip", _IP, _ip), ("card", _CARD, _card), ("phone", _PHONE, _phone))
_HAS_DIGIT = re.compile("[0-9]")


def plain(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind."""
    out = [(a, b, "email") for a, b in _emails(text)]
    if _HAS_DIGIT.search(text):
        for kind, pattern, good in _NUMERIC:
            if kind != "phone" or "+" in text:
                out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if good(m)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("асеорхуіјѕԁһќтвнкмАСЕОРХУІЈЅВНКМТαοενιρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aceopxyijsdhktbhkmACEOPXYIJSBHKMTaoeviptukABEZHIKMNOPTYX", strict=True))
# Digits in words.
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

# Ends of host names, country and generic ones of the public suffix list. Those of OPEN_ENDINGS may be words of running text.
ENDINGS = frozenset("""
    ac ad ae aero af ag ai al ao app aq ar arpa asia au aw ax az ba bb bf bg bh bi biz bj blog bm bn bo br bs bt bv bw bz ca cat cc cd cf cg ch ci cl
    cloud cm cn co com coop cr cu cv cw cx cy cz de dev dj dk dm dz ec edu ee eg email es et eu fi fj fm fo fr ga gb gd ge gf gg gh gi gl gm gn gov gp gq
    gr gs gt gu gw gy hk hm hn hr ht hu id ie il im info int io iq ir je jo jobs jp ke kg ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc
    md mg mh mil mk ml mn mo mobi mp mq mr ms mt mu mv mw mx mz na nc ne net nf ng ni nl nr nu nz om online org pa pe pf ph pk pl pm pn pr ps pt pw py qa
    re ro rs ru rw sa sb sc sd se sg sh si sj sk sl sm sn sr ss st su sv sx sy sz tc td tech tel tf tg th tj tk tl tm tn tr tt tv tw tz ua ug uk us uy uz
    va vc ve vg vi vn vu website wf wiki ws xyz ye yt zm zw
""".split())
OPEN_ENDINGS = frozenset("""
    aaa aarp abarth abb abbott abbvie abc able abogado abudhabi academy accenture accountant accountants aco actor ads adult aeg aetna afl africa agakhan
    agency aig airbus airforce airtel akdn alfaromeo alibaba alipay allfinanz allstate ally alsace alstom am amazon americanexpress americanfamily amex
    amfam amica amsterdam analytics android anquan anz aol apartments apple aquarelle arab aramco archi army art arte as asda associates at athleta
    attorney auction audi audible audio auspost author auto autos avianca aws axa azure baby baidu banamex bananarepublic band bank bar barcelona
    barclaycard barclays barefoot bargains baseball basketball bauhaus bayern bbc bbt bbva bcg bcn be beats beauty beer bentley berlin best bestbuy bet
    bharti bible bid bike bing bingo bio black blackfriday blockbuster bloomberg blue bms bmw bnpparibas boats boehringer bofa bom bond boo book booking
    bosch bostik boston bot boutique box bradesco bridgestone broadway broker brother brussels build builders business buy buzz by bzh cab cafe cal call
    calvinklein cam camera camp canon capetown capital capitalone car caravan cards care career careers cars casa case cash casino catering catholic cba
    cbn cbre cbs center ceo cern cfa cfd chanel channel charity chase chat cheap chintai christmas chrome church cipriani circle cisco citadel citi citic
    city cityeats claims cleaning click clinic clinique clothing club clubmed coach codes coffee college cologne comcast commbank community company
    compare computer comsec condos construction consulting contact contractors cooking cookingchannel cool corsica country coupon coupons courses cpa
    credit creditcard creditunion cricket crown crs cruise cruises cuisinella cymru cyou dabur dad dance data date dating datsun day dclk dds deal dealer
    deals degree delivery dell deloitte delta democrat dental dentist desi design dhl diamonds diet digital direct directory discount discover dish diy
    dnp do docs doctor dog domains dot download drive dtv dubai dunlop dupont durban dvag dvr earth eat eco edeka education emerck energy engineer
    engineering enterprises epson equipment ericsson erni esq estate etisalat eurovision eus events exchange expert exposed express extraspace fage fail
    fairwinds faith family fan fans farm farmers fashion fast fedex feedback ferrari ferrero fiat fidelity fido film final finance financial fire
    firestone firmdale fish fishing fit fitness flickr flights flir florist flowers fly foo food foodnetwork football ford forex forsale forum foundation
    fox free fresenius frl frogans frontdoor frontier ftr fujitsu fun fund furniture futbol fyi gal gallery gallo gallup game games gap garden gay gbiz
    gdn gea gent genting george ggee gift gifts gives giving glass gle global globo gmail gmbh gmo gmx godaddy gold goldpoint golf goo goodyear goog
    google gop got grainger graphics gratis green gripe grocery group guardian gucci guge guide guitars guru hair hamburg hangout haus hbo hdfc hdfcbank
    health healthcare help helsinki here hermes hgtv hiphop hisamitsu hitachi hiv hkt hockey holdings holiday homedepot homegoods homes homesense honda
    horse hospital host hosting hot hoteles hotels hotmail house how hsbc hughes hyatt hyundai ibm icbc ice icu ieee ifm ikano imamat imdb immo immobilien
    in inc industries infiniti ing ink institute insurance insure international intuit investments ipiranga irish is ismaili ist istanbul it itau itv
    jaguar java jcb jeep jetzt jewelry jio jll jmp jnj joburg jot joy jpmorgan jprs juegos juniper kaufen kddi kerryhotels kerrylogistics kerryproperties
    kfh kia kids kim kinder kindle kitchen kiwi koeln komatsu kosher kpmg kpn krd kred kuokgroup kyoto lacaixa lamborghini lamer lancaster lancia land
    landrover lanxess lasalle lat latino latrobe law lawyer lds lease leclerc lefrak legal lego lexus lgbt lidl life lifeinsurance lifestyle lighting like
    lilly limited limo lincoln linde link lipsy live living llc llp loan loans locker locus loft lol london lotte lotto love lpl lplfinancial ltd ltda
    lundbeck luxe luxury macys madrid maif maison makeup man management mango map market marketing markets marriott marshalls maserati mattel mba mckinsey
    me med media meet melbourne meme memorial men menu merckmsd miami microsoft mini mint mit mitsubishi mlb mls mma mobile moda moe moi mom monash money
    monster mormon mortgage moscow moto motorcycles mov movie msd mtn mtr museum music mutual my nab nagoya name natura navy nba nec netbank netflix
    network neustar new news next nextdirect nexus nfl ngo nhk nico nike nikon ninja nissan nissay no nokia northwesternmutual norton now nowruz nowtv nra
    nrw ntt nyc obi observer office okinawa olayan olayangroup oldnavy ollo omega one ong onion onl ooo open oracle orange organic origins osaka otsuka
    ott ovh page panasonic paris pars partners parts party passagens pay pccw pet pfizer pharmacy phd philips phone photo photography photos physio pics
    pictet pictures pid pin ping pink pioneer pizza place play playstation plumbing plus pnc pohl poker politie porn post pramerica praxi press prime pro
    prod productions prof progressive promo properties property protection pru prudential pub pwc qpon quebec quest racing radio read realestate realtor
    realty recipes red redstone redumbrella rehab reise reisen reit reliance ren rent rentals repair report republican rest restaurant review reviews
    rexroth rich richardli ricoh ril rio rip rocher rocks rodeo rogers room rsvp rugby ruhr run rwe ryukyu saarland safe safety sakura sale salon samsclub
    samsung sandvik sandvikcoromant sanofi sap sarl sas save saxo sbi sbs sca scb schaeffler schmidt scholarships school schule schwarz science scot
    search seat secure security seek select sener services ses seven sew sex sexy sfr shangrila sharp shaw shell shia shiksha shoes shop shopping shouji
    show showtime silk sina singles site ski skin sky skype sling smart smile sncf so soccer social softbank software sohu solar solutions song sony soy
    spa space sport spot srl stada staples star statebank statefarm stc stcgroup stockholm storage store stream studio study style sucks supplies supply
    support surf surgery suzuki swatch swiss sydney systems tab taipei talk taobao target tatamotors tatar tattoo tax taxi tci tdk team technology temasek
    tennis teva thd theater theatre tiaa tickets tienda tiffany tips tires tirol tjmaxx tjx tkmaxx tmall to today tokyo tools top toray toshiba total
    tours town toyota toys trade trading training travel travelchannel travelers travelersinsurance trust trv tube tui tunes tushu tvs ubank ubs unicom
    university uno uol ups vacations vana vanguard vegas ventures verisign versicherung vet viajes video vig viking villas vin vip virgin visa vision viva
    vivo vlaanderen vodka volkswagen volvo vote voting voto voyage vuelos wales walmart walter wang wanggou watch watches weather weatherchannel webcam
    weber wedding weibo weir whoswho wien williamhill win windows wine winners wme wolterskluwer woodside work works world wow wtc wtf xbox xerox xfinity
    xihuan xin xxx yachts yahoo yamaxun yandex yodobashi yoga yokohama you youtube yun zappos zara zero zip zone zuerich
""".split())
#: Words before a dot that make it one of running text, as in "look at the dot in".
DETERMINERS = frozenset("a an the this that these those each every any some my your his her its our their".split())

_FULL_WIDTH = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_OTHER_DIGITS = {chr(c): str(unicodedata.digit(chr(c))) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Nd"}
_INVISIBLE = "­​‌‍‎‏⁠﻿"
_SWAP = {**_OTHER_DIGITS, **_FULL_WIDTH, **LOOKALIKES, **dict.fromkeys("    　", " "), **dict.fromkeys("‐‑‒–−", "-")}
_ODD = re.compile("[" + "".join(map(re.escape, _SWAP)) + _INVISIBLE + "]")

_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
#: At least seven digits in words (digits may stand between), with spaces or hyphens.
_SPELLED = re.compile(rf"(?i)(?<![a-z0-9])(?:(?:{_WORD}|[0-9]+|plus|\+)[ \-.]{{1,3}}){{6,}}(?:{_WORD}|[0-9]+)(?![a-z0-9])")
_SPELLED_PART = re.compile(rf"(?i){_WORD}|plus")
_AT = r"(?: ?[\[({<] ?(?:at|@) ?[\])}>] ?| +at +| +@ +)"
_DOT = r"(?: ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| +dot +| +\. +)"
_BETWEEN = re.compile(rf"(?i)({_AT})|({_DOT})")
#: Parts of name AT host DOT host, at least one of them in disguise. A run of spaces is tried from its first one only.
_AT_SIGN = re.compile(r"(?i) ?[\[({<] ?(?:at|@) ?[\])}>] ?|(?<! ) ++at ++|(?<! ) ++@ ++|@")
_DOT_SIGN = re.compile(r"(?i) ?[\[({<] ?(?:dot|\.) ?[\])}>] ?|(?<! ) ++dot ++|(?<! ) ++\. ++|\.")
_NAME_OR_DOT = re.compile(rf"(?P<name>[A-Za-z0-9_%+-]++)|{_DOT_SIGN.pattern[4:]}", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_ENDING = re.compile(r"[A-Za-z]{2,24}(?![A-Za-z0-9])")
_STOPS = re.compile(r"\s*(?:[.,;:!?)\]}>\"'\n]|$)")
_DISGUISED_IP = re.compile(rf"(?i)(?<![0-9.])[0-9]{{1,3}}(?:(?:\.|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9])")
_HINT = re.compile(r"(?i)[\[({<] ?(?:at|@|dot|\.) ?[\])}>]| dot | @ ")
_HINT_SPELLED = re.compile(rf"(?i)(?<![a-z])(?:{_WORD})[ \-.]{{1,3}}(?:{_WORD}|[0-9]+)(?![a-z])")


class Mapped:
    """A text and, for each of its characters, the source span (start, end) that it stands for."""

    def __init__(self, text: str, starts: Sequence[int] | None = None, ends: Sequence[int] | None = None):
        self.text = text
        self.starts = range(len(text)) if starts is None else starts
        self.ends = range(1, len(text) + 1) if ends is None else ends

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace the given parts; the characters of a replacement all stand for the whole part."""
        if not edits:
            return self
        out: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        at = 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            out.append(self.text[at:a])
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            if new:
                out.append(new)
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            at = b
        return Mapped("".join(out), starts, ends)

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.starts[a], self.ends[b - 1]


def look_alikes(m: Mapped) -> Mapped:
    return m.rewrite([(x.start(), x.end(), _SWAP.get(x[0], "")) for x in _ODD.finditer(m.text)])


def _name(text: str, begin: int, end: int) -> list[tuple[int, int]] | None:
    """Signs between the dotted parts of the longest name in ``text[begin:end]`` that ends at ``end``; None without a name."""
    parts = list(_NAME_OR_DOT.finditer(text, begin, end))
    if not parts or parts[-1].end() != end or not parts[-1]["name"]:
        return None
    signs, k = [], len(parts) - 1
    while k >= 2 and parts[k - 2]["name"] and not parts[k - 1]["name"]:
        if parts[k - 1].end() != parts[k].start() or parts[k - 2].end() != parts[k - 1].start():
            break
        signs.append(parts[k - 1].span())
        k -= 2
    return signs[::-1]


def _hosts(text: str, at: int) -> tuple[list[tuple[int, int]], list[tuple[int, str]]]:
    """Signs between the dotted labels at ``at``; and for each sign the end of the host and its ending, '' if the label after it is none."""
    signs: list[tuple[int, int]] = []
    ends: list[tuple[int, str]] = []
    label = _LABEL.match(text, at)
    while label and (sign := _DOT_SIGN.match(text, label.end())) and (label := _LABEL.match(text, sign.end())):
        last = _ENDING.match(text, label.start())
        signs.append(sign.span())
        ends.append((last.end(), last[0].lower()) if last else (label.end(), ""))
    return signs, ends


def _bare(text: str, at: int, signs: list[tuple[int, int]], end: int, ending: str) -> bool:
    """Whether a host after a bare " at ", an ordinary word, counts: by its ending, and as no running text."""
    if text[at : signs[0][0]].lower() in DETERMINERS:
        return False
    return ending in ENDINGS or (ending in OPEN_ENDINGS and bool(_STOPS.match(text, end)))


def disguised_signs(m: Mapped) -> Mapped:
    edits = []
    text, done, before = m.text, 0, 0
    for sign in _AT_SIGN.finditer(text):
        begin, before = max(done, before), sign.end()
        if sign.start() < done:
            continue
        inner = _name(text, begin, sign.start())
        if inner is None:
            continue
        signs, ends = _hosts(text, sign.end())
        # A bare " at " counts only beside a disguised dot, which the host has from its sign number ``first`` on.
        bare = not re.search(r"[\[({<@]", sign[0])
        first = 1
        if bare and all(b - a == 1 for a, b in inner):
            first = next((n for n, (a, b) in enumerate(signs, 1) if b - a > 1), len(ends) + 1)
        for n in range(len(ends), first - 1, -1):
            end, ending = ends[n - 1]
            if ending and (not bare or _bare(text, sign.end(), signs, end, ending)):
                edits += [(a, b, ".") for a, b in inner + signs[:n] if b - a > 1]
                if sign[0] != "@":
                    edits.append((*sign.span(), "@"))
                done = end
                break
    for whole in _DISGUISED_IP.finditer(m.text):
        edits += [(p.start(), p.end(), ".") for p in _BETWEEN.finditer(m.text, whole.start(), whole.end())]
    # Two readings of one place: the first stays.
    kept: list[tuple[int, int, str]] = []
    for e in sorted(set(edits)):
        if not kept or e[0] >= kept[-1][1]:
            kept.append(e)
    return m.rewrite(kept)


def spelled_digits(m: Mapped) -> Mapped:
    edits = []
    for run in _SPELLED.finditer(m.text):
        for p in _SPELLED_PART.finditer(m.text, run.start(), run.end()):
            edits.append((p.start(), p.end(), "+" if p[0].lower() == "plus" else SPELLED[p[0].lower()]))
    return m.rewrite(edits)


#: A run of single digits with spaces is one number; the patterns above allow only one sign between digits.
_LOOSE = re.compile(r"\+?[0-9](?:[ \-.]{1,3}[0-9]+)+")


def disguised(text: str) -> list[tuple[int, int, str]]:
    """Spans that only the normalised text shows."""
    odd, hint, spelled = _ODD.search(text), _HINT.search(text), _HINT_SPELLED.search(text)
    if not (odd or hint or spelled):
        return []
    m = Mapped(text)
    for step, on in ((look_alikes, odd), (disguised_signs, odd or hint), (spelled_digits, odd or spelled)):
        m = step(m) if on else m
    out = [(*m.source(a, b), kind) for a, b, kind in plain(m.text)]
    if spelled or odd:
        for run in _LOOSE.finditer(m.text):
            a, b = m.source(run.start(), run.end())
            if b - a == run.end() - run.start():
                continue  # nothing was rewritten here
            digits = _NO_DIGIT.sub("", run[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((a, b, "card"))
            elif 10 <= len(digits) <= 15:
                out.append((a, b, "phone"))
    return sorted(set(out))


def find(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Plain spans, and all spans: those and the disguised ones that touch none of the same kind or hold it whole."""
    base = plain(text)
    more = disguised(text)
    if not more:
        return base, base
    taken = {k: [(a, b) for a, b, kind in base if kind == k] for k in KINDS}
    for a, b, kind in more:
        if all(b <= x or y <= a or (a <= x and y <= b and (a, b) != (x, y)) for x, y in taken[kind]):
            taken[kind].append((a, b))
    every = [(a, b, k) for k in KINDS for a, b in taken[k]]
    return base, sorted(every, key=lambda s: (s[0], KINDS.index(s[2])))


def line(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: plain spans counted by kind and hashed, and all spans (code points, end exclusive)."""
    tune(docs.sparkSession)

    def run(batch: list[str]) -> dict[str, Sequence]:
        found = [find(t) for t in batch]
        counts = {f"n_{k}": [sum(s[2] == k for s in base) for base, _ in found] for k in KINDS}
        return counts | {
            "base_sha256": [hashlib.sha256(line(base).encode()).hexdigest() for base, _ in found],
            "spans": [line(every) for _, every in found],
        }

    return per_document(texts(docs), run, SCHEMA)


def mask(text: str) -> str:
    """The text with each span, overlapping ones of several kinds taken together, replaced by its kind in angle brackets."""
    out, at = [], 0
    merged: list[list] = []
    for a, b, kind in find(text)[1]:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[at:a], f"<{kind}>"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """Every row and column of ``docs`` with personal data masked in ``text``; a NULL text stays NULL."""
    tune(docs.sparkSession)
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        for b in batches:
            masked = [None if t is None else mask(t) for t in b.column(names.index("text")).to_pylist()]
            cols = [pa.array(masked, pa.string()) if n == "text" else b.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)
