"""Inputs derived from the given tables, written once as SQL for both engines.

Each derivation keeps whole tables and whole texts. Only three spellings differ between the engines:
replacing every match of a pattern, the name of the text type, and the cut of a piece, which Spark makes from bytes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.operators.shaping import computed_once
from seqframe.session import spread

# A source's own names would be read, not derived; this one stands in for them.
DERIVED_ONCE = {"elements": "element"}

TABLES = ("customer", "orders", "lineitem", "events", "documents", "labels", "conversations", "part", "supplier")


def letters(text: str, duck: bool) -> str:
    """ASCII letters of a text, upper case (ASCII first: engines differ in how they raise some others)."""
    every = ", 'g'" if duck else ""
    return f"upper(regexp_replace({text}, '[^A-Za-z]', ''{every}))"


def derivations(duck: bool) -> dict[str, str]:
    """Name to SQL; later names may read earlier ones."""
    text, whole = ("varchar", "bigint") if duck else ("string", "int")
    count = "greatest(1, cast(ceil(length(b) / 64.0) as int))"
    numbers = f"unnest(range({count}))" if duck else f"explode(sequence(0, {count} - 1))"
    # Letters are ASCII, so bytes count as letters do; Spark would walk a text from its start to the place of each piece.
    held = "d.*" if duck else "doc_id, lang, source, cast(b as binary) as b"
    piece = f"substr(b, cast(i * 64 + 1 as {whole}), 64)"
    piece = piece if duck else f"cast({piece} as string)"
    let = letters("text", duck)
    dna = f"translate({let}, 'BDEFHIJKLMOPQRSUVWXYZ', 'CTAGCTAGCTAGCTNRYSWKM')"
    return {
        # Clean letters of every document, as nucleotides and as residues.
        "dna": f"select doc_id, lang, source, {dna} as b from documents",
        "protein": f"select doc_id, lang, source, {let} as b from documents",
        # The same with one kind of dirt per residue class of the id.
        "dirty_dna": f"""
            select doc_id as ord, cast(doc_id as {text}) as sample_id, lang, source,
                   case doc_id % 11 when 1 then lower(b)
                     when 2 then concat(substr(b, 1, 10), ' ', substr(b, 11), chr(10))
                     when 3 then '' when 4 then concat(b, 'U') when 5 then concat('1', b)
                     when 6 then '  ' else b end as sequence
            from dna""",
        "dirty_protein": f"""
            select doc_id as ord, cast(doc_id as {text}) as sample_id,
                   case doc_id % 7 when 1 then concat(b, '*') when 2 then concat(b, '_*')
                     when 3 then concat(substr(b, 1, 5), '*', substr(b, 6))
                     when 4 then translate(b, 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTNACGTNACGTNACGTNA')
                     else b end as sequence
            from protein""",
        "rna": f"""
            select doc_id as ord, cast(doc_id as {text}) as sample_id, translate(b, 'T', 'U') as sequence
            from dna""",
        # Labelled nucleotide records.
        "labelled": f"""
            select d.doc_id as ord, cast(d.doc_id as {text}) as sample_id, d.b as sequence, d.lang, d.source,
                   l.quality, l.toxic
            from dna d join labels l on d.doc_id = l.doc_id""",
        "all_labelled": f"""
            select d.doc_id as ord, cast(d.doc_id as {text}) as sample_id, d.b as sequence, d.lang,
                   case when length(d.b) % 2 = 0 then 1 else 0 end as even, case when d.lang = 'en' then 1 else 0 end as english
            from dna d""",
        # Both again, each sequence cut into pieces of 64 letters, a record for each: rows of fixed width over whole texts.
        "pieces": f"""
            select doc_id * 1000000 + i as ord, doc_id, lang, source, {piece} as b
            from (select {held}, {numbers} as i from dna d) p""",
        "labelled_pieces": f"""
            select p.ord, cast(p.ord as {text}) as sample_id, p.b as sequence, p.lang, p.source, l.quality, l.toxic
            from pieces p join labels l on p.doc_id = l.doc_id""",
        "all_pieces": f"""
            select ord, cast(ord as {text}) as sample_id, b as sequence, lang,
                   case when length(b) % 2 = 0 then 1 else 0 end as even, case when lang = 'en' then 1 else 0 end as english
            from pieces""",
        # Membership lists: the priority of an order is the class, its customer the member.
        "members": f"select o_orderpriority as class, cast(o_custkey as {text}) as id from orders",
        "dictionary": f"select cast(doc_id as {text}) as id, b as sequence from protein",
        # Matched pairs, some with a missing member, some of unequal length.
        "pairs": f"""
            select doc_id as ord, lang as organism, cast(doc_id % 50 as {text}) as "GeneID", source as description,
                   b as protein, case when doc_id % 13 = 0 then '' else b end as natural_dna,
                   case when doc_id % 7 = 0 then substr(b, 2) else translate(b, 'ACGT', 'GTAC') end as finetune_dna
            from dna""".replace('"', '"' if duck else "`"),
        # Event-signature names; the declared length is off by one for every 17th.
        "elements": f"""
            select concat('LBNL_IF', lpad(cast(doc_id as {text}), cast(greatest(5, length(cast(doc_id as {text}))) as int), '0'), '_gene_',
                     cast(length(b) + case when doc_id % 17 = 0 then 1 else 0 end as {text}), 'bp_',
                     case when doc_id % 10 = 9 then 'CDSpartial_' else '' end,
                     case doc_id % 9 when 0 then 'insertion' when 1 then 'deletion' when 2 then 'plasmid.element'
                       when 3 then 'insertion.site' when 4 then 'inversion' when 5 then 'compound.deletion'
                       when 6 then 'compound.insertion' when 7 then 'plasmid' else 'reassortment' end,
                     '_Genus.species', case when doc_id % 4 = 0 then '_flank1' else '' end) as element,
                   b as sequence, doc_id
            from dna""",
        # Links by conversation; those beyond the documents name elements that do not exist.
        "links": f"""
            select e.element, concat(c.role, cast(c.turn as {text})) as sample
            from conversations c join elements e on c.conv_id = e.doc_id
            union all
            select concat('lost_', cast(conv_id as {text})) as element, role as sample from conversations""",
        # One-hot rows: which event type a user's first event had.
        "one_hot": """
            select user_id,
                   cast(max(case when k = 'click' then 1 else 0 end) as double) as e_click,
                   cast(max(case when k = 'error' then 1 else 0 end) as double) as e_error,
                   cast(max(case when k = 'purchase' then 1 else 0 end) as double) as e_purchase,
                   cast(max(case when k = 'signup' then 1 else 0 end) as double) as e_signup,
                   cast(max(case when k = 'view' then 1 else 0 end) as double) as e_view
            from (select user_id, min_by(event_type, event_id) as k from events group by user_id) u
            group by user_id""",
        # Calls with conflicts, and features that some of them reach.
        "calls": f"""
            select cast(l_orderkey as {text}) as file, cast(l_linenumber as {text}) as id, l_returnflag as call
            from lineitem""",
        "features": f"""
            select cast(doc_id as {text}) as file, cast(doc_id % 7 + 1 as {text}) as id, lang as name, b as sequence,
                   case when doc_id % 5 = 0 then null else source end as role, lang as source,
                   '0' as "sourceStart", cast(length(b) as {text}) as "sourceEnd", 'x#inline' as "sourceOrientation"
            from dna""".replace('"', '"' if duck else "`"),
        "detections": f"select cast(o_custkey as {text}) as sample, o_orderstatus as call from orders",
        # Inventories: every document is expected, every labelled one was found, some changed, and
        # the orders found beside them were not expected.
        "expected": f"select concat('d/', cast(doc_id as {text})) as path, md5(text) as content_hash from documents",
        "found": f"""
            select concat('d/', cast(d.doc_id as {text})) as path,
                   case when l.quality = 1 then md5(d.text) else md5(concat(d.text, 'x')) end as content_hash
            from documents d join labels l on d.doc_id = l.doc_id
            union all
            select concat('o/', cast(o_orderkey as {text})) as path, md5(cast(o_custkey as {text})) as content_hash from orders""",
    }


class Inputs:
    """Derived inputs as lazy DataFrames, each built from the given parquet tables when asked for."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf
        self._sql = derivations(duck=False)
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in self._made:
            return self._made[name]
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf}/{name}.parquet")
            if name == "documents":  # the one table whose rows need much work each
                df = spread(df.select("doc_id", "text", "lang", "source", "n_chars"), "doc_id")
        elif name in self._sql:
            sql = self._sql[name]
            used = {n: getattr(self, n) for n in (*TABLES, *self._sql) if n != name and _mentions(sql, n)}
            df = self.spark.sql(_bind(sql, used), **used)
            if name in DERIVED_ONCE:
                column = DERIVED_ONCE[name]
                kept = [c for c in df.columns if c != column]
                df = computed_once(df, kept, **{column: F.col(column)}).select(*df.columns)
        else:
            raise AttributeError(name)
        self._made[name] = df
        return df


def _mentions(sql: str, name: str) -> bool:
    return re.search(rf"\b(from|join) {name}\b", sql) is not None


def _bind(sql: str, used: dict[str, DataFrame]) -> str:
    for name in used:
        sql = re.sub(rf"\b(from|join) {name}\b", rf"\1 {{{name}}}", sql)
    return sql


def with_ctes(*names: str) -> str:
    """``with …`` clause defining the named inputs and what they read, for the SQL twins."""
    sql = derivations(duck=True)
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in sql:
            if other != name and _mentions(sql[name], other):
                need(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        need(name)
    return "with " + ", ".join(f"{n} as ({sql[n]})" for n in wanted)
