"""Vocabularies of the normalizer, and their YAML files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Legal forms, address abbreviations, landmark markers, countries, address stop words, phonetic rules.
LEGAL = {
    "ltd": "limited", "limited": "limited", "pvt": "private", "pvt ltd": "private limited", "private": "private",
    "inc": "incorporated", "incorporated": "incorporated", "corp": "corporation", "corporation": "corporation",
    "co": "company", "company": "company", "llc": "llc", "llp": "llp", "plc": "plc", "gmbh": "gmbh",
    "sarl": "sarl", "s.a.r.l": "sarl", "sas": "sas", "s.a.s": "sas", "sasu": "sasu", "sa": "sa", "s.a": "sa",
    "eurl": "eurl", "sci": "sci", "snc": "snc", "gie": "gie",
}
ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway",
    "expy": "expressway", "cir": "circle", "ct": "court", "pl": "place", "sq": "square", "pkwy": "parkway",
    "ter": "terrace", "way": "way", "apt": "apartment", "ste": "suite", "fl": "floor", "bldg": "building",
    "dept": "department", "rm": "room", "ofc": "office", "no": "number", "bd": "boulevard", "bld": "boulevard",
    "av": "avenue", "imp": "impasse", "all": "allee", "r": "rue", "rt": "route", "res": "residence",
    "bat": "batiment", "etg": "etage",
}
LANDMARKS = (
    "near", "opp", "opposite", "behind", "beside", "next to", "adjacent to", "in front of", "above", "below",
    "close to", "nr", "adj", "pres de", "face a", "en face de", "proche de", "a cote de",
)
COUNTRIES = {
    "us": "us", "usa": "us", "united states": "us", "united states of america": "us", "india": "india", "ind": "india",
    "in": "india", "bharat": "india", "france": "france", "fr": "france", "fra": "france",
}
ADDRESS_STOPWORDS = (
    "floor", "road", "street", "house", "near", "number", "plot", "building", "block", "first", "second", "third",
    "ground", "main", "opp", "opposite", "behind", "beside", "delhi", "india", "state", "city", "lane", "avenue",
    "nagar", "bazaar", "market", "room", "shop", "office", "unit", "phase", "sector", "dist", "district", "area",
    "west", "east", "north", "south", "central", "colony", "complex", "towers", "plaza",
)
PHONETIC = (
    ("shree|shri", "sri"), ("laxmi", "lakshmi"), ("choudhary|choudhury|chaudhry", "chaudhary"),
    ("enterprises|enterprise|ent", "enterprise"), ("associates|assoc", "associate"), ("traders|trader", "trader"),
    ("services|service|serv", "service"), ("technologies|technology|tech", "tech"), ("industries|industry|ind", "industry"),
    ("centre|center", "center"), ("international|intl", "international"), ("pharmaceuticals|pharma", "pharma"),
    ("corporation|corp", "corp"), ("medical|med", "medical"), ("brothers|bros", "bros"), ("agencies|agency", "agency"),
)
#: Rules that the diagnostic variant leaves out.
PHONETIC_DIAGNOSTIC_OMITS = ("bros", "agency")
# End of the fixed values.

FILES = {"legal": "legal_suffix_map", "abbreviations": "abbreviation_map", "landmarks": "landmark_markers", "countries": "country_map"}


@dataclass(frozen=True)
class Vocabulary:
    legal: dict[str, str] = field(default_factory=lambda: dict(LEGAL))
    abbreviations: dict[str, str] = field(default_factory=lambda: dict(ABBREVIATIONS))
    landmarks: tuple[str, ...] = LANDMARKS
    countries: dict[str, str] = field(default_factory=lambda: dict(COUNTRIES))

    @property
    def legal_tokens(self) -> tuple[str, ...]:
        return tuple(sorted({t for k, v in self.legal.items() for t in (*k.split(), *v.split())}))


def _flat(value: str) -> str:
    return value.strip().strip("'\"")


def load(spark: SparkSession, folder: str) -> Vocabulary:
    """The vocabulary in a folder's YAML files (flat maps and one flat list), read through Spark; a missing file gives its default."""
    found: dict = {}
    for name, stem in FILES.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{stem}.yaml")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            continue
        lines = [r.value for r in spark.read.text(f"{folder}/{stem}.yaml").collect() if r.value.strip() and not r.value.lstrip().startswith("#")]
        if name == "landmarks":
            found[name] = tuple(_flat(x.lstrip()[1:]) for x in lines if x.lstrip().startswith("-"))
        else:
            found[name] = {_flat(k): _flat(v) for k, _, v in (x.partition(":") for x in lines)}
    return Vocabulary(**{k: v for k, v in found.items() if v})


def save(spark: SparkSession, vocabulary: Vocabulary, folder: str) -> None:
    for name, stem in FILES.items():
        value = getattr(vocabulary, name)
        lines = [f"{stem}:", *[f"- {x}" for x in sorted(value)]] if name == "landmarks" else [f"'{k}': '{v}'" for k, v in sorted(value.items())]
        spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(f"{folder}/{stem}.yaml")


def mine_countries(frames: list[DataFrame]) -> DataFrame:
    """country: trimmed lower-case spellings in the frames that the default map lacks."""
    every = None
    for f in frames:
        own = f.select(F.lower(F.trim("country")).alias("country"))
        every = own if every is None else every.unionByName(own)
    return every.where("country <> ''").where(~F.col("country").isin(*COUNTRIES)).distinct()
