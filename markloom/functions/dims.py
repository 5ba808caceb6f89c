"""Names that decide what the converter keeps, drops or skips.

They are data, meant to be replaced by a caller as template usage drifts
(`TemplatePolicy.of`, `TagPolicy`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _names(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(part.strip() for part in text.split("|") if part.strip()))


# --- fixed values: section headings that are removed ---
REMOVED_SECTIONS = _names(
    """references | works cited | bibliography | further reading | published works | external links
    | notes | notes and references | literature cited | sources | citations
    | sources and further reading | footnotes | sources cited"""
)

# --- fixed values: name prefixes of page-sized templates, left out of a census ---
# "fs " ends in a space on purpose.
BIG_PREFIXES = (
    "football", "fs ", "quote box", "infobox", "multiple", "portal", "listen", "speciesbox",
    "video game reviews", "tree chart", "album ratings", "film ratings", "game ratings",
    "music ratings", "song ratings", "television episode ratings", "television season ratings",
    "television ratings", "tv ratings", "wide image", "automatic taxobox", "pp", "pp-move",
    "pp-vandalism", "s-ttl",
)

# --- fixed values: parser functions ---
PARSER_FUNCTIONS = _names(
    """#count | #explode | #expr | #if | #ifeq | #iferror | #ifexpr | #ifexist | #len | #pos
    | #replace | #rpos | #switch | #time | #timeel | #urldecode | formatnum | #dateformat
    | #formatdate"""
)

# --- fixed values: kept templates, first letter lower-cased ---
KEPT_TEMPLATES = _names(
    """abbr | asterisk | as of | bibleverse | blockquote | bq | quote | bquote | quotation
    | birth date | birth date and age | birth year | birth year and age
    | death date | death date and age | death year and age
    | block indent | center | circa | clear | - | clr | chem | chem2 | convert | cquote
    | currentyear | cvt | dash year | date | delta | dinogloss | em | e | 10^ | x10^
    | em dash | -- | mdash | endash | en dash | ndash | nsndns | equationNote | equationRef | f1
    | flag | flagu | flagIOC | flagIOC2 | flaglink | fbw | flagathlete
    | format price | formatprice | fraction | frac | sfrac | gRT | hyphen
    | ill | interlanguage link | iNR | indian Rupee | iNRConvert | iPAc-en | respell
    | inrconvert | jcon | jct | lang | langnf | lambda | h-phrases | p-phrases
    | literal translation | lit | lit. | literally | mabs
    | mLB Year | mlby | baseball year | nbay | nBA Year | nFL Year
    | math | mset | mvar | abs | norm | mono | monospace | tt | ttt
    | nbsp | &nbsp | nbs | nbsp; | space | spcs | non breaking en dash | nbnd | nbndash
    | navy | nee | nihongo | nihongo2 | nFLplayer | nobold | nuclide
    | not a typo | as written | chem name | proper name | typo | not typo | nat | NAT
    | noitalic | ni | yesitalic | nowrap | nobr | nobreak | okina
    | percent | percentage | pct | winning percentage | pi | plainlist | post-nominals
    | poem quote | poemquote | radic | ratio | refbegin | refend
    | reign | r. | reigned | rexit | ruled | round | rnd
    | sclass | sclass2 | ship | hMS | sS | uSNS | uSS | sMS | sMU | sic | small
    | stl | station link | rws | stnlnk | station | stn
    | allcaps | caps | nocaps | smallcaps | smallcaps2 | smallcapsall | aut | sc | sc1 | sc2 | sm
    | sms | spaced en dash | spaced ndash | dash | snd | spnd | sndash | spndash | sqrt | start date | strikethrough | strike | s
    | strong | sub | sup | transliteration | transl | trans
    | unbulleted list | ubl | ubt | ublist | unbullet | ordered list | plain list | pL
    | ushr | uSpolabbr | u.S. politician abbreviation | uS$ | val | wikidata | yEAR | zh
    | + | = | • | * | bull | bullet | ' | '- | 's | '" | "' | ' " | single+double
    | cURRENTYEAR | cURRENTMONTH | cURRENTMONTH1 | cURRENTMONTH2 | cURRENTMONTHNAME
    | cURRENTMONTHNAMEGEN | cURRENTMONTHABBREV"""
)
KEPT_PREFIX = "lang-"

# --- fixed values: country codes used as template names ---
COUNTRY_CODES = tuple(dict.fromkeys(
    """ABW ARU AFG AGO ANG ANT AHO AIA ALA ALB AND ARE UAE ARG ARM ASM ASA ATA ATF ATG AUS AUT AZE BDI BEL BEN BES
    BFA BGD BGR BUL BHR BHS BAH BIH BLM BLR BLZ BIZ BMU BER BOL BRA BRB BAR BRN BRU BTN BHU BVT BWA BOT CAF CTA CAN CCK CHE
    SUI SWI CHL CHI CHN PRC CHN-ROC CIV CMR COD COG CGO COK COL COM CPV CRI CRC CUB CUW CUR CXR CYM CAY CYP CZE CSK TCH DEU
    GER GDR DDR FRG DJI DMA DNK DEN DOM DZA ALG ECU EGY ERI ESH SADR ESP EST ETH FIN FJI FIJ FLK FRA FRO FSM GAB GBR UK ENG
    SCO SCT WAL WLS NIR GEO GGY GHA GIB GIN GUI GLP GMB GAM GNB GBS GNQ GEQ EQG GRC GRE GRD GRN GRL GTM GUA GUF GUM GUY HKG
    HKG-CHN HMD HND HON HRV CRO HTI HAI HUN IDN INA IMN IND IOT IRL IRN IRI IRQ ISL ISR ITA JAM JEY JOR JPN KAZ KEN KGZ KHM
    CAM KIR KNA SKN KOR ROK KWT KUW LAO LBN LIB LBR LBY LBA LCA LIE LKA SRI LSO LES LTU LUX LVA LAT MAC MAC-CHN MAF MAR MCO
    MON MDA MDG MAD MDV MEX MHL MKD NMK MLI MLT MMR MYA MNE MNG MGL MNP MOZ MRT MTN MSR MTQ MUS MRI MWI MAW MYS MAS MYT NAM
    NCL NER NIG NFK NGA NGR NIC NCA NIU NLD NED NOR NPL NEP NRU NZL NZ OMN OMA PAK PAN PCN PER PHL PHI PLW PNG POL PRI PUR
    PRK DPRK PRT POR PRY PAR PSE PLE PYF QAT REU ROU ROM RUS RWA SAU KSA SDN SUD SEN SGP SIN SGS SHN SJM SLB SOL SLE SLV ESA
    SMR SOM SPM SRB SSD STP SUR SVK SVN SLO SWE SWZ SXM SYC SEY SYR TCA TCD CHA TGO TOG THA TJK TKL TKM TLS ETM TON TGA TTO
    TRI TUN TUR TUV TWN ROC TWN-ROC ROC-TW TPE CHN-ROC TZA TAN UGA UKR UMI UNO URS URY URU USA US USSR UZB VAT VCT VIN VEN
    VGB IVB VIR ISV VNM VIE VUT VAN WLF WSM SAM YEM YUG FR-YUG ZAF RSA ZMB ZAM ZWE ZIM""".split()
))

# --- fixed values: tag policy ---
TAGS_KEEP = _names("br|sub|sup|blockquote|math|syntaxhighlight|code|pre|ul|li|ol|nowiki")
TAGS_KEEP_STYLED = _names("u|del")
TAGS_UNWRAP = _names(
    """p|abbr|bdi|bdo|cite|data|dfn|mark|ruby|rp|rt|rb|samp|small|time|var|center|font|a|big
    |onlyinclude|section|chem|ce"""
)
TAGS_UNWRAP_PLAIN = _names("u|b|strong|i|em|del|s|strike")
TAGS_DELETE = _names(
    """style|hr|wbr|div|table|td|tr|th|caption|thead|tfoot|tbody|noinclude|hiero|ref
    |templatestyles|phonos|gallery|indicator|timeline|references|img"""
)
# tag -> (text for the opening tag, text for the closing tag)
TAGS_REWRITE = {
    "h1": ("= ", " ="),
    "h2": ("== ", " =="),
    "h3": ("=== ", " ==="),
    "h4": ("==== ", " ===="),
    "h5": ("===== ", " ====="),
    "h6": ("====== ", " ======"),
    "b": ("'''", "'''"),
    "strong": ("'''", "'''"),
    "i": ("''", "''"),
    "em": ("''", "''"),
    "ins": ("<u>", "</u>"),
    "q": ('"', '"'),
    "s": ("<del>", "</del>"),
    "strike": ("<del>", "</del>"),
    "kbd": ("<code>", "</code>"),
    "tt": ("<code>", "</code>"),
    "dl": ("", ""),
    "dt": ("; ", ""),
    "dd": (": ", ""),
    "poem": ("<blockquote>", "</blockquote>"),
}
# Tags whose content the wiki parser takes as plain text.
TAGS_OPAQUE = _names("math|nowiki|pre|syntaxhighlight|source")


def lower_first(name: str) -> str:
    return name[:1].lower() + name[1:]


def is_one_of(name: Column, names: Iterable[str]) -> Column:
    """Membership in a fixed set of names, by one look into a hash set.

    The set is one parsed expression: a Column per name makes the plan slow to build.
    """
    listed = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in sorted(names))
    if not listed:
        return name.isNull() & F.lit(None).cast("boolean")
    return F.get(F.call_function("transform", F.array(name), F.expr(f"n -> n IN ({listed})")), F.lit(0))


@dataclass(frozen=True)
class TemplatePolicy:
    """Which templates survive the clean-up. All names are in first-letter-lowered form."""

    keep: frozenset[str]
    prefix: str = KEPT_PREFIX
    functions: tuple[str, ...] = PARSER_FUNCTIONS

    @classmethod
    def default(cls) -> TemplatePolicy:
        return cls(frozenset(KEPT_TEMPLATES) | frozenset(lower_first(code) for code in COUNTRY_CODES))

    @classmethod
    def of(cls, names: Iterable[str]) -> TemplatePolicy:
        """A policy from names in the code. A table of names is joined instead (`operators.policy`)."""
        return cls(frozenset(lower_first(n) for n in names))

    def keeps(self, name: Column) -> Column:
        """True for a normalised template name that stays in the text."""
        return is_one_of(name, self.keep) | _by_rule(name, self.prefix, self.functions)

    def table(self, spark: SparkSession) -> DataFrame:
        """The whole policy as rows (kind, name): names, the prefix, parser functions."""
        rows = [("name", n) for n in sorted(self.keep)]
        rows += [("prefix", self.prefix)] + [("function", f) for f in self.functions]
        return spark.createDataFrame(rows, "kind string, name string")


def _by_rule(name: Column, prefix: str, functions: tuple[str, ...]) -> Column:
    return name.startswith(prefix) | F.substring_index(name, ":", 1).isin(*functions)


@dataclass(frozen=True)
class ListedPolicy:
    """A policy whose names lie in a table: `column` of a page holds those of its own names that are in there."""

    column: str
    prefix: str = KEPT_PREFIX
    functions: tuple[str, ...] = PARSER_FUNCTIONS

    def keeps(self, name: Column) -> Column:
        return F.array_contains(F.col(self.column), name) | _by_rule(name, self.prefix, self.functions)


@dataclass(frozen=True)
class TagPolicy:
    """What happens to each tag. `styled` keeps bold, italics and the like."""

    styled: bool = False
    keep: tuple[str, ...] = TAGS_KEEP
    unwrap: tuple[str, ...] = TAGS_UNWRAP
    delete: tuple[str, ...] = TAGS_DELETE
    rewrite: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(TAGS_REWRITE))

    def actions(self) -> dict[str, str]:
        """Tag -> action; the first rule that names a tag wins."""
        keep = self.keep + (TAGS_KEEP_STYLED if self.styled else ())
        unwrap = self.unwrap + (() if self.styled else TAGS_UNWRAP_PLAIN)
        ordered = [(t, "keep") for t in keep]
        ordered += [(t, "unwrap") for t in unwrap]
        ordered += [(t, "delete") for t in self.delete]
        ordered += [("span", "unwrap")] + [(t, "rewrite") for t in self.rewrite]
        table: dict[str, str] = {}
        for tag, action in ordered:
            table.setdefault(tag, action)
        return table

    def having(self, action: str) -> list[str]:
        return [t for t, a in self.actions().items() if a == action]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, a, *self.rewrite.get(t, (None, None))) for t, a in self.actions().items()]
        return spark.createDataFrame(rows, "tag string, action string, opening string, closing string")
