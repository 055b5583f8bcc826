"""License scan with ordered signature rules, in DataFrame functions only.

Texts become their words (A-Z lower-cased; digits, letters and everything beyond ASCII make
words).  A rule is a regular expression over whole words with a keyword, a label, a priority
and a confidence.  ``rules`` builds some hundreds of them from the hand-written name
patterns of ``NAMES`` and the sentence forms of ``FORMS``.

Per row, without a shuffle: one test asks whether any keyword occurs at all; only then each rule whose
own keyword and context word occur marks its matches in the text, and the marks' word places give
intervals.  Intervals are read by start, longest first, then by priority: one that lies inside
the last accepted is suppressed; of two that overlap in part the one with the better priority stays, whichever
comes first, and both stay if they rank alike.  What stays gives the labels.  The phrases of ``BASE`` are rules as well; their
places are all counted and their labels never suppressed.

Edge cases: null and empty texts have no words and no labels; a text of any length is read whole;
repeated rows give equal rows; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import lower_az, text_or_empty

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: fixed values: phrase -> label
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, keyword that every match holds, pattern of the name in words
NAMES = [
    ("mit", "mit", r"mit|mit x11|expat mit"),
    ("mit-0", "attribution", r"mit no attribution"),
    ("apache-1.1", "apache", r"apache (?:software )?(?:license )?(?:version )?v?1 1"),
    ("apache-2", "apache", r"apache (?:software )?(?:license )?(?:version )?v?2(?: 0)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd 2(?: clause)?|bsd simplified"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd|bsd 3(?: clause)?|bsd new"),
    ("bsd-4-clause", "bsd", r"(?:original|old|4 clause|four clause) bsd|bsd 4(?: clause)?"),
    ("bsd", "bsd", r"bsd|bsd style"),
    ("0bsd", "0bsd", r"0bsd|zero clause bsd 0bsd"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng"),
    ("gpl-1", "general", r"gnu general public license (?:version |v )?1(?: 0)?"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl (?:version )?v?2(?: 0)?(?: only| or later)?|gplv2"),
    ("gpl-2", "general", r"gnu general public license (?:version |v )?2(?: 0)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl (?:version )?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-3", "general", r"gnu general public license (?:version |v )?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gpl", "general", r"gnu general public license"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl (?:version )?v?2 1"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public license (?:version |v )?2 1"),
    ("lgpl-3", "lgpl", r"(?:gnu )?lgpl (?:version )?v?3(?: 0)?"),
    ("lgpl-3", "lesser", r"gnu lesser general public license (?:version |v )?3(?: 0)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("lgpl", "lesser", r"gnu lesser general public license"),
    ("agpl-3", "agpl", r"(?:gnu )?agpl(?: (?:version )?v?3(?: 0)?)?"),
    ("agpl-3", "affero", r"gnu affero general public license(?: (?:version |v )?3(?: 0)?)?"),
    ("mpl-1.1", "mpl", r"mpl (?:version )?v?1 1"),
    ("mpl-2", "mpl", r"mpl(?: (?:version )?v?2(?: 0)?)?"),
    ("mpl-1.1", "mozilla", r"mozilla public license (?:version |v )?1 1"),
    ("mpl-2", "mozilla", r"mozilla public license(?: (?:version |v )?2(?: 0)?)?"),
    ("epl-1", "eclipse", r"eclipse public license (?:version |v )?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?: (?:version |v )?2(?: 0)?)?"),
    ("cddl-1", "cddl", r"cddl(?: (?:version )?v?1(?: [01])?)?"),
    ("cddl-1", "distribution", r"common development and distribution license(?: (?:version |v )?1(?: [01])?)?"),
    ("eupl-1.2", "eupl", r"eupl(?: (?:version )?v?1 [12])?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("artistic-1", "artistic", r"artistic license (?:version |v )?1(?: 0)?"),
    ("artistic-2", "artistic", r"artistic license(?: (?:version |v )?2(?: 0)?)?"),
    ("bsl-1", "boost", r"boost software license(?: (?:version |v )?1(?: 0)?)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("python-2", "python", r"python software foundation license(?: (?:version |v )?2)?"),
    ("openssl", "openssl", r"openssl license"),
    ("ofl-1.1", "ofl", r"ofl(?: (?:version )?v?1 1)?"),
    ("ofl-1.1", "sil", r"sil open font license(?: (?:version |v )?1 1)?"),
    ("cc0-1", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1234] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1234] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1234] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1234] [05])?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: [1234] [05])?"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: [1234] [05])?"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: [1234] [05])?"),
    ("cc-by", "creative", r"creative commons attribution(?: [1234] [05])?"),
    ("public-domain", "domain", r"public domain(?: dedication)?"),
    ("proprietary", "reserved", r"all rights reserved"),
]

#: priority (smaller wins), confidence, what every match holds besides the name, sentence form around a name
FORMS = [
    (1, 1.0, " spdx ", r"spdx license identifier (?:{0})(?: only| or later)?"),
    (2, 0.95, " under ", r"(?:licensed|released|distributed|published|provided|available|redistributed|shared) under (?:the )?(?:terms of (?:the )?|conditions of (?:the )?)?(?:{0})(?: licen[cs]e)?(?: terms)?"),
    (3, 0.9, " under ", r"under (?:the )?(?:terms of (?:the )?)?(?:{0})(?: licen[cs]e)?"),
    (4, 0.85, " licen", r"(?:subject to|governed by|covered by|see) (?:the )?(?:terms of (?:the )?)?(?:{0}) licen[cs]e"),
    (5, 0.85, " licen", r"licen[cs]e (?:is |type |name |text |notice )?(?:the )?(?:{0})"),
    (6, 0.8, " licen", r"(?:the )?(?:{0}) licen[cs]ed?"),
]
#: names of two words or more need no sentence around them
BARE = (7, 0.6, " ", r"(?:{0})")


def rules() -> list[dict]:
    """All rules in order: base phrases, then every form of every name."""
    out = [{"label": label, "keyword": phrase.split()[-2 if phrase.endswith("license") else 0], "context": " ",
            "priority": 0, "score": 1.0, "pattern": phrase, "base": True} for phrase, label in BASE.items()]
    for label, keyword, name in NAMES:
        forms = FORMS + ([BARE] if " " in name.split("|")[0].replace("(?: ", "") else [])
        out += [{"label": label, "keyword": keyword, "context": context, "priority": p, "score": score,
                 "pattern": form.replace("{0}", name), "base": False} for p, score, context, form in forms]
    for r in out:
        r["pattern"] = f"(?<= )(?:{r['pattern']})(?= )"
        r["keyword"] = f" {r['keyword']}" if r["keyword"] in ("gpl", "lgpl", "agpl", "mpl") else f" {r['keyword']} "
    return out


RULE_TYPE = ("array<struct<label:string,keyword:string,context:string,priority:int,score:double,"
             "pattern:string,base:boolean>>")
_HIT = "array<struct<start:int,less:int,priority:int,label:string,score:double,base:boolean>>"
_STATE = "struct<end:int,priority:int,label:string,score:double,labels:array<string>,best:double>"


def word_text(text: Column) -> Column:
    """The words, one space before, between and after them; one space if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_az(text), F.lit(" ")), NOT_WORD, " ")


def hits(words: Column, rule_list: Column, keywords: Column) -> Column:
    """All matches of all rules: (start, -end, priority, label, score, base), end exclusive, sorted."""
    def of_rule(r):
        # marks before and behind each match; neither character occurs in word text
        marked = F.split(F.trim(F.regexp_replace(words, r["pattern"], F.lit("\x01$0\x02"))), " ")

        def places(mark, plus):
            at = F.transform(marked, lambda w, i: F.when(mark(w), i + plus))
            return F.filter(at, lambda i: i.isNotNull())

        starts = places(lambda w: F.startswith(w, F.lit("\x01")), 0)
        ends = places(lambda w: F.endswith(w, F.lit("\x02")), 1)
        return F.zip_with(starts, ends, lambda s, e: F.struct(
            s.cast("int").alias("start"), (-e).cast("int").alias("less"), r["priority"].alias("priority"),
            r["label"].alias("label"), r["score"].alias("score"), r["base"].alias("base")))

    def of_present(present):
        fit = F.filter(rule_list, lambda r: F.array_contains(present, r["keyword"]) & F.array_contains(present, r["context"]))
        return F.flatten(F.transform(fit, of_rule))

    present = F.filter(keywords, lambda k: F.contains(words, k))
    return F.array_sort(F.get(F.transform(F.array(present), of_present), 0))


def scan(docs: DataFrame, rule_list: list[dict] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row."""
    rule_list = rules() if rule_list is None else rule_list
    table = F.from_json(F.lit(json.dumps(rule_list)), RULE_TYPE)
    keywords = F.from_json(F.lit(json.dumps(sorted({r[k] for r in rule_list for k in ("keyword", "context")}))), "array<string>")
    any_keyword = "(?:" + "|".join(sorted({r["keyword"].strip() for r in rule_list})) + ")"
    none = F.array().cast(_HIT)

    def read(words):
        spaces = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
        return F.struct((spaces - 1).cast("long").alias("n_words"),
                        F.when(F.rlike(words, F.lit(f" {any_keyword}")), hits(words, table, keywords)).otherwise(none).alias("hits"))

    # a one-element transform names the words, so that they are made once
    rows = docs.select("doc_id", F.get(F.transform(F.array(word_text(text_or_empty())), read), 0).alias("r"))
    rows = rows.select("doc_id", "r.n_words", "r.hits")

    def settled(a):
        """Labels and best score with the last interval's."""
        return (F.when(a["label"].isNull(), a["labels"]).otherwise(F.array_union(a["labels"], F.array(a["label"]))),
                F.greatest(a["best"], a["score"]))

    def step(a, h):
        # sorted by start, longest first: a match inside the last one is suppressed; of two that overlap in part the
        # better rule stays alone, and both stay if the rules rank alike
        end = -h["less"]
        apart = h["start"] >= a["end"]
        replaces = ~apart & (end > a["end"]) & (h["priority"] < a["priority"])
        joins = apart | ((end > a["end"]) & (h["priority"] == a["priority"]))
        labels, best = settled(a)
        return F.when(replaces | joins, F.struct(
            end.alias("end"), h["priority"].alias("priority"), h["label"].alias("label"), h["score"].alias("score"),
            F.when(joins, labels).otherwise(a["labels"]).alias("labels"), F.when(joins, best).otherwise(a["best"]).alias("best")).cast(_STATE)).otherwise(a)

    start = F.struct(F.lit(0).alias("end"), F.lit(99).alias("priority"), F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("score"),
                     F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("best")).cast(_STATE)

    def finish(a):
        labels, best = settled(a)
        return F.struct(labels.alias("labels"), best.alias("score"))

    rows = rows.select("doc_id", "n_words", F.filter("hits", lambda h: h["base"]).alias("base"),
                       F.aggregate("hits", start, step, finish).alias("kept"))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda h: h["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda h: h["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda h: h["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.transform("base", lambda h: h["label"]), "kept.labels")), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.col("kept.score")).alias("score"))
