"""The SQL twin of every registered query that SQL can express, over the same tables."""

from __future__ import annotations

from seqframe.plans.validate import CHECK_NAMES
from workload.inputs import with_ctes
from workload.queries import CAP, CLASSES, STRIDE, WIDTH

ORACLES: dict[str, str] = {}

WS = r"[ \t\r\n\x0B\f]+"
DNA_OK, PROTEIN_OK = "ACGTRYSWKMBDHVN", "A-Z"


def put(name: str, sql: str) -> None:
    ORACLES[name] = sql


def tokens(text: str, width: int | None = None) -> str:
    """Comma-joined tokens of a text, padded to a width when one is given."""
    row = text if width is None else f"rpad({text}, {width}, '@')"
    return f"array_to_string(list_transform(string_split({row}, ''), lambda c: ascii(c) - 64), ',')"


def lanes(digest: str) -> str:
    sums = ", ".join(
        f"cast(coalesce(sum(cast(concat('0x', substr({digest}, {1 + 6 * i}, 6)) as bigint)), 0) as varchar)" for i in range(10)
    )
    return f"sha256(concat_ws(',', cast(count({digest}) as varchar), {sums}))"


def row_digest(*cells: str) -> str:
    spelled = [f"coalesce(length({c})::varchar || ':' || {c}, '-')" for c in cells]
    return f"sha256({' || '.join(spelled)})"


# ---- cleaning ---------------------------------------------------------------------------------

DNA_CLEAN = f"""
bare as (select *, regexp_replace(sequence, '{WS}', '', 'g') as t from dirty_dna),
up as (select * exclude (sequence), sequence as raw, upper(t) as u from bare),
cleaned as (
  select ord, sample_id, u as sequence, length(u) as original_length,
    case when u = '' then 'empty_after_cleaning' when regexp_matches(u, '[^{DNA_OK}]') then 'invalid_characters' end as reason,
    raw <> t as whitespace_stripped, t <> u as uppercased,
    list_sort(list_distinct(string_split(regexp_replace(u, '[{DNA_OK}]+', '', 'g'), ''))) as bad
  from up),
detailed as (
  select *, case reason when 'empty_after_cleaning' then 'nothing is left once white space is removed'
    when 'invalid_characters' then concat('not valid for dna_nucleotide: ', array_to_string(bad, ' '),
      case when list_contains(bad, 'U') then '; U needs rna_to_dna or another alphabet' else '' end) end as detail
  from cleaned),
ok as (select ord, sample_id, sequence, original_length from cleaned where reason is null)"""
PROTEIN_CLEAN = f"""
bare as (select *, upper(regexp_replace(sequence, '{WS}', '', 'g')) as t from dirty_protein),
cleaned as (
  select ord, sample_id, sequence as raw, t, rtrim(t, '*_') as u from bare),
flagged as (
  select *, case when u = '' then 'empty_after_cleaning' when regexp_matches(u, '[^A-Z]') then 'invalid_characters' end as reason
  from cleaned)"""


def dna(body: str) -> str:
    return f"{with_ctes('dirty_dna')}, {DNA_CLEAN} {body}"


def protein(body: str) -> str:
    return f"{with_ctes('dirty_protein')}, {PROTEIN_CLEAN} {body}"


def report(source: str, **flags: str) -> str:
    counted = {
        "uppercased": "false", "whitespace_stripped": "false", "terminator_stripped": "false", "u_to_t_converted": "false",
        "quarantined": "reason is not null", "quarantined_empty": "reason = 'empty_after_cleaning'",
        "quarantined_invalid": "reason = 'invalid_characters'",
        "protein_sequences_using_only_nucleotide_letters": "false",
    } | flags
    cols = ", ".join(f"count(*) filter ({v}) as {k}" for k, v in counted.items())
    return f"select count(*) as seen, {cols} from {source}"


put(
    "clean_dna",
    dna("select sample_id, sequence, original_length, reason, detail, whitespace_stripped, uppercased from detailed"),
)
put(
    "clean_protein",
    protein("""select sample_id, u as sequence, length(u) as original_length, reason,
      case reason when 'empty_after_cleaning' then 'nothing is left once white space is removed'
        when 'invalid_characters' then concat('not valid for amino_acid: ',
          array_to_string(list_sort(list_distinct(string_split(regexp_replace(u, '[A-Z]+', '', 'g'), ''))), ' ')) end as detail,
      u <> t as terminator_stripped, reason is null and regexp_full_match(u, '[ACGTN]+') as nucleotide_lookalike from flagged"""),
)
put("quarantine_table", dna("select sample_id, reason, detail from detailed where reason is not null"))
put("quarantine_reasons", dna("select reason, count(*) as n from cleaned where reason is not null group by reason"))
put("cleaning_report", dna(report("cleaned", uppercased="uppercased", whitespace_stripped="whitespace_stripped")))
put(
    "cleaning_report_protein",
    protein(
        report(
            "flagged",
            terminator_stripped="u <> t",
            protein_sequences_using_only_nucleotide_letters="reason is null and regexp_full_match(u, '[ACGTN]+')",
        )
    ),
)
put(
    "cleaning_report_rna",
    f"""{with_ctes('rna')}, flagged as (select sequence, case when sequence = '' then 'empty_after_cleaning' end as reason from rna)
    {report('flagged', u_to_t_converted="contains(sequence, 'U')")}""",
)
put(
    "ambiguity_profile",
    dna("""select c as letter, cast(sum(length(sequence) - length(replace(sequence, c, ''))) as bigint) as n
      from ok, (select unnest(string_split('BDHKMNRSVWY', '')) as c) codes group by c
      having sum(length(sequence) - length(replace(sequence, c, ''))) > 0"""),
)
put(
    "looks_like_nucleotide",
    f"{with_ctes('dirty_protein')} select sample_id, regexp_full_match(sequence, '[ACGTN]+') as lookalike from dirty_protein",
)

# ---- encoding and placement -------------------------------------------------------------------

put("encode", dna(f"select sample_id, {tokens('sequence')} as tokens from ok"))
put("decode_roundtrip", dna("select sample_id, sequence as decoded, true as same from ok"))
put(
    "clean_encode_pad",
    dna(f"""select sample_id, {tokens('left(sequence, 64)', 64)} as tokens, 1 as window_start, least(length(sequence), 64)::int as window_end,
      (64 - least(length(sequence), 64))::int as padding_cells, (length(sequence) - least(length(sequence), 64))::int as removed,
      sha256(left(sequence, 64)) as slice_digest from ok"""),
)


def windows(cap: int | None) -> str:
    kept = "n" if cap is None else f"least(n, {cap})"
    return f"""counted as (
      select *, length(sequence) as l, case when length(sequence) <= {WIDTH} then 1
        else cast(ceil((length(sequence) - {WIDTH}) / {STRIDE}.0) as int) + 1 end as n from ok),
    kept as (select *, {kept} as k from counted),
    placed as (
      select sample_id as parent_sample_id, l, n, k, i, substr(sequence, (i * {STRIDE} + 1)::bigint, {WIDTH}) as slice
      from (select *, unnest(range(k)) as i from kept) e),
    measured as (
      select concat(parent_sample_id, '__w', lpad(i::varchar, greatest(2, length((k - 1)::varchar))::int, '0')) as sample_id,
        parent_sample_id, (i * {STRIDE} + 1)::int as window_start, (i * {STRIDE} + length(slice))::int as window_end,
        length(slice)::int as residues_in_row, ({WIDTH} - length(slice))::int as padding_cells,
        (case when i = k - 1 then n - k else 0 end)::int as windows_dropped,
        (case when i = k - 1 and n > k then greatest(l - (i * {STRIDE} + length(slice)), 0) else 0 end)::int as residues_dropped_by_window_cap,
        sha256(slice) as slice_digest, slice from placed)"""


WINDOW_LIST = """sample_id, parent_sample_id, window_start, window_end, residues_in_row, padding_cells,
  residues_dropped_by_window_cap, slice_digest"""
put("windows", dna(f", {windows(None)} select {WINDOW_LIST} from measured"))
put("windows_capped", dna(f", {windows(CAP)} select {WINDOW_LIST} from measured"))
put("window_tokens", dna(f", {windows(None)} select sample_id, {tokens('slice', WIDTH)} as tokens from measured"))
put(
    "conversion_totals",
    dna(f""", {windows(CAP)} select count(*) as n_rows, sum(windows_dropped)::bigint as windows_dropped,
      sum(residues_dropped_by_window_cap)::bigint as residues_dropped_by_window_cap, 0::bigint as residues_removed_by_truncation,
      sum(residues_in_row)::bigint as residues_in_row, sum(padding_cells)::bigint as padding_cells from measured"""),
)
put(
    "windows_per_parent",
    dna(f", {windows(None)} select parent_sample_id, count(*) as n_rows from measured group by parent_sample_id"),
)
put(
    "length_summary",
    dna("""select count(*) as n_records, min(length(sequence))::int as min_length, max(length(sequence))::int as max_length,
      list_sort(list(length(sequence)))[count(*) // 2 + 1]::int as median_length from ok"""),
)

# ---- conversion of the labelled documents -----------------------------------------------------

CONVERTED = "conv as (select * from labelled_pieces where sequence <> '')"
put(
    "convert_samples",
    f"""{with_ctes('labelled_pieces')}, {CONVERTED} select ord, sample_id, sample_id as parent_sample_id, 'documents' as source,
      length(sequence)::int as original_length, 1 as window_start, least(length(sequence), 64)::int as window_end,
      least(length(sequence), 64)::int as residues_in_row, (64 - least(length(sequence), 64))::int as padding_cells,
      (length(sequence) - least(length(sequence), 64))::int as residues_removed_by_truncation, 0 as residues_dropped_by_window_cap,
      sha256(sequence) as slice_digest, lang, source as origin from conv""",
)
put(
    "wide_table",
    f"""{with_ctes('labelled_pieces')}, {CONVERTED}, t as (select *, rpad(sequence, 64, '@') as r from conv)
      select sample_id, quality as target_0, toxic as target_1, """
    + ", ".join(f"(ascii(substr(r, {i}, 1)) - 64)::tinyint as position_{i:02d}" for i in range(1, 65))
    + " from t",
)
put(
    "ordered_digest",
    dna(f", d as (select {row_digest('ord::varchar', 'sample_id', 'sequence')} as h from ok) "
        f"select count(*) as n_rows, {lanes('h')} as content_digest from d"),
)
BODY = row_digest(
    "sample_id", "concat(quality::varchar, ',', toxic::varchar)", "rpad(sequence, 64, '@')"
)
TABLE_ROW = row_digest("ord::varchar", BODY)
put(
    "table_digest",
    f"{with_ctes('labelled_pieces')}, {CONVERTED}, d as (select {TABLE_ROW} as h from conv) "
    f"select count(*) as n_rows, {lanes('h')} as content_digest from d",
)
LONG = """long as (select ord, sample_id, source, 0 as target_index, quality as target from labelled
  union all select ord, sample_id, source, 1, toxic from labelled)"""
TARGET_HASH = row_digest("ord::varchar", "sample_id", "target::varchar")
put(
    "target_digests",
    f"{with_ctes('labelled')}, {LONG}, d as (select target_index, {TARGET_HASH} as h from long) "
    f"select target_index, count(*) as n_rows, {lanes('h')} as content_digest from d group by target_index",
)
put("compare_runs", "select 'rerunning_with_the_same_config_is_byte_identical' as name, true as passed")
put(
    "run_differences",
    dna(f""", a as (select sample_id, sequence from ok), b as (select sample_id, left(sequence, {WIDTH}) as sequence from ok)
      select sample_id, 1::bigint as in_first, 0::bigint as in_second from a where length(sequence) > {WIDTH}
      union all select a.sample_id, 0, 1 from a where length(sequence) > {WIDTH}"""),
)

# ---- pairs ------------------------------------------------------------------------------------

PAIRS = f"""status as (select *, case when natural_dna = '' or finetune_dna = '' then 'missing_sequence'
    when length(natural_dna) <> length(finetune_dna) then 'length_mismatch' end as pair_drop from pairs),
  keyed as (select *, left({row_digest('organism', '"GeneID"', 'description', 'natural_dna')}, 12) as content_key
    from status where pair_drop is null),
  numbered as (select *, row_number() over (partition by content_key order by ord) - 1 as repeat from keyed),
  named as (select *, concat('ct_', content_key, case when repeat = 0 then '' else concat('_', repeat::varchar) end) as pair_id
    from numbered)"""
put(
    "pair_drops",
    f"""{with_ctes('pairs')}, {PAIRS} select count(*) filter (pair_drop = 'missing_sequence') as dropped_missing,
      count(*) filter (pair_drop = 'length_mismatch') as dropped_length_mismatch, count(*) filter (pair_drop is null) as kept from status""",
)


def pair_side(member: str, label: int, column: str) -> str:
    return f"""select concat(pair_id, '__{member}') as sample_id, {column} as sequence, {label} as label, pair_id, '{member}' as member,
      organism, "GeneID" as gene_id, length(protein)::int as protein_length, description from named"""


put(
    "pairs_dataset",
    f"{with_ctes('pairs')}, {PAIRS} {pair_side('natural', 0, 'natural_dna')} union all {pair_side('finetune', 1, 'finetune_dna')}",
)
put("union_extracts", f"{with_ctes('all_labelled')} select sample_id, sequence from all_labelled")
put(
    "extract_conflicts",
    f"""{with_ctes('dna', 'protein')} select d.doc_id::varchar as sample_id from dna d join protein p on d.doc_id = p.doc_id
      where d.b <> p.b""",
)
LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
put(
    "repeat_counter",
    f"select l_returnflag, {LINE_ORDER}, row_number() over (partition by l_returnflag order by {LINE_ORDER}) - 1 as repeat from lineitem",
)
PART = "case when l_linenumber <> 2 then l_partkey end"
put(
    "repeat_counter_nulls",
    f"""with t as (select case when l_linenumber <> 1 then l_returnflag end as key, {LINE_ORDER.replace('l_partkey', PART + ' as l_partkey')} from lineitem)
      select key, {LINE_ORDER}, row_number() over (partition by key order by l_orderkey, l_linenumber, l_partkey nulls first,
        l_suppkey, l_extendedprice) - 1 as repeat from t""",
)
put(
    "balanced_cap_nulls",
    """with t as (select doc_id, case when doc_id % 4 <> 0 then lang end as label from documents)
      select doc_id, label, row_number() over (partition by label order by doc_id) - 1 as rank from t order by rank, label nulls first limit 100""",
)
put(
    "group_straddle",
    f"""{with_ctes('pairs')} select "GeneID" as gene, count(*) as n_rows from pairs group by 1
      having count(distinct organism = 'en') > 1""",
)

# ---- membership -------------------------------------------------------------------------------

VOCABULARY = ", ".join(f"'{c}'" for c in CLASSES)
SETS = f"""sets as (select id, list_sort(list_distinct(list(class))) as cs from members group by id),
  vectors as (select id, cs, array_to_string(list_transform([{VOCABULARY}], lambda c: case when list_contains(cs, c) then 1 else 0 end), ',')
    as label from sets)"""
put("lines_per_class", f"{with_ctes('members')} select class, count(*) as n from members group by class")
put(
    "membership_matrix",
    f"{with_ctes('members')}, {SETS} select id, array_to_string(cs, '|') as classes, label from vectors",
)
put(
    "resolved_members",
    f"""{with_ctes('members', 'dictionary')} select distinct m.id, d.sequence from members m join dictionary d on m.id = d.id
      where d.sequence <> ''""",
)
put(
    "unresolved_members",
    f"{with_ctes('members', 'dictionary')} select distinct id from members where id not in (select id from dictionary)",
)
put(
    "positives_per_class",
    f"""{with_ctes('members', 'dictionary')} select class, count(distinct m.id) as n from members m
      join dictionary d on m.id = d.id where d.sequence <> '' group by class""",
)
put(
    "round_robin_cap",
    f"""{with_ctes('members')}, ranked as (select class, id, row_number() over (partition by class order by id) - 1 as depth
        from (select distinct class, id from members) m),
      turns as (select id, depth, class, row_number() over (partition by id order by depth, class) as rn from ranked)
      select id, depth, class from turns where rn = 1 order by depth, class limit 500""",
)
put(
    "membership_dataset",
    f"""{with_ctes('members', 'dictionary')}, {SETS} select v.id as sample_id, d.sequence, v.label, array_to_string(cs, '|') as classes,
      len(cs)::int as n_classes from vectors v join dictionary d on v.id = d.id where d.sequence <> ''""",
)

# ---- classes and one-hot ----------------------------------------------------------------------

put(
    "class_index",
    "select source, (row_number() over (order by source) - 1)::int as index from (select distinct source from documents) s",
)
COUNTS = f"""{with_ctes('labelled_pieces')}, {CONVERTED}, counts as (
  select 0 as target_index, quality as value, count(*) as n from conv group by quality
  union all select 1, toxic, count(*) from conv group by toxic)"""
put("class_counts", f"{COUNTS} select * from counts")
put(
    "class_balance",
    f"""{COUNTS} select target_index, count(*) as n_distinct_classes,
      case when count(*) > 1 then round_even(min(n) / max(n), 4) end as class_balance_min_over_max from counts group by target_index""",
)
FIRST_EVENT = "first_event as (select user_id, min_by(event_type, event_id) as k from events group by user_id)"
put("one_hot_collapse", f"with {FIRST_EVENT} select user_id, concat('e_', k) as class from first_event")
put(
    "labels_outside_vocabulary",
    f"""{with_ctes('labelled')} select distinct source from documents where source not in
      (select source from labelled where toxic = 1)""",
)
put(
    "attribution_dataset",
    f"""{with_ctes('dna')}, {FIRST_EVENT}, vocab as (select unnest(['e_click', 'e_error', 'e_purchase', 'e_signup', 'e_view']) as c,
        unnest([0, 1, 2, 3, 4]) as label)
      select d.doc_id::varchar as sample_id, d.b as sequence, v.label, v.c as lab_id, (v.c = 'e_view')::int as is_pooled_unknown_lab,
        d.lang as species_lang
      from dna d join first_event f on d.doc_id = f.user_id join vocab v on v.c = concat('e_', f.k)""",
)
put(
    "balanced_cap",
    f"""{with_ctes('labelled')}, ranked as (select sample_id, quality, row_number() over (partition by quality order by sample_id) - 1 as rank
      from labelled) select * from ranked order by rank, quality limit 100""",
)
put(
    "length_baseline",
    f"""{with_ctes('labelled')}, l as (select length(sequence) as len, quality from labelled),
      per as (select len, count(*) filter (quality = 1) as ones, count(*) filter (quality = 0) as zeros from l group by len),
      acc as (select (sum(ones) over (order by len desc rows unbounded preceding)
          + coalesce(sum(zeros) over (order by len rows between unbounded preceding and 1 preceding), 0))
          / (select count(*) from l) as a from per)
      select case when (select count(distinct quality) from l) = 2 then round_even(max(a), 4) else 0.0 end as length_only_baseline_accuracy
      from acc""",
)

# ---- event elements ---------------------------------------------------------------------------

KINDS = "['insertion', 'compound.insertion', 'plasmid.element', 'plasmid', 'deletion', 'compound.deletion', 'insertion.site']"
PARSED = f"""core as (select *, regexp_replace(element, '(?i)_flank[0-9]$', '') as core from elements),
  tail as (select *, list_slice(p, list_position(list_transform(p, lambda t: regexp_full_match(t, '[0-9]+bp')), true) + 1, len(p)) as tail
    from (select *, string_split(lower(core), '_') as p from core) s),
  parsed as (select element, sequence, coalesce(list_filter(tail, lambda t: list_contains({KINDS}, t))[1], tail[1], 'unparsed') as element_type,
      regexp_matches(element, '(?i)_flank[0-9]$') as is_flank,
      case when regexp_matches(string_split(core, '_')[-1], '^[A-Z]') then replace(string_split(core, '_')[-1], '.', ' ') else '' end as origin_organism,
      coalesce(nullif(regexp_extract(element, '(?i)_([0-9]+)bp_', 1), ''), nullif(regexp_extract(element, '(?i)_([0-9]+)bp$', 1), ''))::bigint
        as declared_length,
      nullif(regexp_extract(element, '(?i)(IF[0-9]+)', 1), '') as element_number from tail),
  events_labelled as (select *, case when element_type = 'insertion.site' then null when is_flank then 0
      when element_type in ('insertion', 'compound.insertion', 'plasmid.element', 'plasmid') then 1
      when element_type in ('deletion', 'compound.deletion') then 0 end as event_label,
    case when element_type = 'insertion.site' then null when is_flank then 'flank: context beside the recorded event'
      when element_type in ('insertion', 'compound.insertion', 'plasmid.element', 'plasmid') then concat(element_type, ': introduced by the recorded event')
      when element_type in ('deletion', 'compound.deletion') then concat(element_type, ': removed by the recorded event') end as label_basis
    from parsed)"""
EVENTS = f"{with_ctes('links')}, {PARSED}"
put("element_parse", f"{EVENTS} select * exclude (sequence) from parsed")
put("event_labels", f"{EVENTS} select element, event_label, label_basis from events_labelled")
put(
    "excluded_types",
    f"""{EVENTS} select element_type, count(*) as n, case when element_type = 'insertion.site'
      then 'names a locus, not where the sequence came from' else 'the type places the sequence in neither class' end as reason
      from events_labelled where event_label is null group by element_type""",
)
put(
    "declared_length_check",
    f"""{EVENTS} select element, declared_length, length(sequence)::int as sequence_length from parsed
      where not is_flank and declared_length <> length(sequence)""",
)
PER_ELEMENT = """per_element as (select element, count(distinct sample) as n_samples,
    array_to_string(list_slice(list_sort(list_distinct(list(sample))), 1, 8), '|') as samples from links group by element)"""
put("samples_per_element", f"{EVENTS}, {PER_ELEMENT} select * from per_element")
put("unlinked_elements", f"{EVENTS} select element from elements where element not in (select element from links)")
put(
    "links_without_element",
    f"""{EVENTS} select distinct element from links where element not in (select element from elements)""",
)
put(
    "event_signature_dataset",
    f"""{EVENTS}, {PER_ELEMENT} select e.element as sample_id, e.sequence, event_label as label, element_type, is_flank::int as is_flank,
      coalesce(n_samples, 0) as n_samples_containing, coalesce(samples, '') as samples_containing, element_number as if_element_number
      from events_labelled e left join per_element p on e.element = p.element where event_label is not null""",
)

# ---- calls ------------------------------------------------------------------------------------

CALLS = """resolved as (select file, id, case when count(distinct call) = 1 then min(call) else 'CONFLICT' end as call
  from calls group by file, id)"""
put(
    "call_resolution",
    f"""{with_ctes('calls')} select file, case when count(distinct call) = 1 then min(call) else 'CONFLICT' end as call
      from calls group by file""",
)
LINKED = f"{with_ctes('calls', 'features', 'detections')}, {CALLS}, linked as (select r.* from resolved r semi join features f on r.file = f.file and r.id = f.id)"
put("call_distribution", f"{LINKED} select call, count(*) as n from linked group by call")
put(
    "call_census",
    f"""{LINKED} select 'features_with_sequence' as measure, count(*) as n from features
      union all select 'total_bp', sum(length(sequence))::bigint from features
      union all select 'detections', count(*) from detections
      union all select 'distinct_samples', count(distinct sample) from detections
      union all select 'features_linkable_to_a_call', count(*) from linked""",
)
put(
    "evidence_roles_dataset",
    f"""{with_ctes('calls', 'features')}, {CALLS},
      vocab as (select role, (row_number() over (order by role) - 1)::int as label from (select distinct role from features where role <> '') r)
      select concat(f.file, '::', f.id) as sample_id, f.sequence, v.label, f.role as part_role, f."sourceEnd" as source_end,
        'inline' as source_orientation, coalesce(r.call, '') as call_not_ground_truth
      from features f join vocab v on f.role = v.role left join resolved r on r.file = f.file and r.id = f.id""",
)

# ---- projection -------------------------------------------------------------------------------

SLUGGED = """case target_index when 0 then 'Quality' else 'Toxic!' end as target_name,
  case target_index when 0 then 'quality' else 'toxic' end as slug"""
put(
    "project_targets",
    f"{with_ctes('labelled')}, {LONG} select ord, target_index, {SLUGGED}, sample_id, target from long",
)
put(
    "source_contract",
    f"""{with_ctes('labelled')}, {LONG}, d as (select target_index, {TARGET_HASH} as h from long),
      t as (select target_index, count(*) as n, {lanes('h')} as digest from d group by target_index)
      select count(*) as target_count, max(n) as row_count, 'Quality|Toxic!' as names, 'quality|toxic' as slugs,
        string_agg(digest, '|' order by target_index) as hashes from t""",
)
put(
    "projection_coverage",
    f"""{with_ctes('labelled')}, s as (select distinct source from labelled)
      select source as source_key, case when source in ('src3', 'src5', 'src7') then 'FAIL' else 'PASS' end as status,
        case source when 'src3' then 'slug and index differ' when 'src5' then 'row counts differ'
          when 'src7' then 'an index is missing' else 'every index present and bound' end as detail,
        case when source = 'src7' then 1 else 2 end::bigint as n_tables from s""",
)

# ---- table quality ----------------------------------------------------------------------------

ROWS = f"""{with_ctes('all_pieces')},
  sound as (select ord, sample_id, even, sequence as slice, rpad(sequence, 64, '@') as r from all_pieces),
  ranged as (select *, case when ord % 31 = 0 then concat('[', substr(r, 2)) else r end as f from sound),
  padded as (select *, case when ord % 37 = 0 then repeat('@', 64) when ord % 29 = 0 then concat(left(r, 1), '@', substr(r, 3)) else r end as f
    from sound)"""
put(
    "token_range",
    f"""{ROWS}, cells as (select ord, list_transform(string_split(f, ''), lambda c: ascii(c) - 64) as t from ranged)
      select count(*) as n_rows, min(list_min(t))::int as token_min, max(list_max(t))::int as token_max,
        count(*) filter (list_min(t) < 0 or list_max(t) > 26) as rows_out_of_range from cells""",
)
INNER = "regexp_matches(f, '@[^@]')"
put(
    "padding_invariant",
    f"""{ROWS} select sum(64 - length(replace(f, '@', '')))::bigint as padding_cells,
      count(*) filter ({INNER}) as rows_with_inner_padding, count(*) filter (replace(f, '@', '') = '') as empty_rows from padded""",
)
put(
    "all_zero_targets",
    f"""{with_ctes('all_labelled')}, long as (select 0 as target_index, english as v from all_labelled
      union all select 1, english * 0 from all_labelled union all select 2, even from all_labelled)
      select target_index from long group by target_index having max(abs(v)) = 0""",
)
put(
    "undocumented_labels",
    f"""{with_ctes('labelled')} select distinct quality + toxic * 2 as value from labelled
      where quality + toxic * 2 not in (select quality from labelled)""",
)
put(
    "duplicate_sequences",
    "select sha256(text) as sequence_digest, count(*) as n_rows from documents group by text having count(*) > 1",
)
put(
    "label_conflicts",
    f"""{with_ctes('labelled')}, cut as (select concat(quality, ',', toxic) as label, substr(sequence, (i * 8 + 1)::bigint, 8) as s
        from (select *, unnest(range(greatest(1, cast(ceil(length(sequence) / 8.0) as int)))) as i from labelled) e)
      select sha256(s) as sequence_digest, count(*)::bigint as n_rows, count(distinct label) as n_labels from cut group by s
      having count(distinct label) > 1""",
)
put("duplicate_keys", "select l_orderkey as sample_id, count(*) as n from lineitem group by 1 having count(*) > 1")
put(
    "duplicate_summary",
    """with d as (select user_id::varchar as k from events group by 1 having count(*) > 1)
      select count(*) as n_duplicated, (select string_agg(k, ', ' order by k) from (select k from d order by k limit 5) f) as examples
      from d""",
)

NOT_EMITTED: dict[str, tuple[str, ...]] = {
    "sound": ("label_dependent_checks_skipped", "remaining_checks_skipped"),
}
DECODE = CHECK_NAMES[CHECK_NAMES.index("no_row_is_silently_empty"):]


def check_rows(ctes: str, skipped: tuple[str, ...], failing: dict[str, str]) -> str:
    """Check rows that pass unless a condition over the data says otherwise."""
    rows = " union all ".join(
        f"select {i} as ordinal, '{n}' as name, {failing.get(n, 'true')} as passed"
        for i, n in enumerate(CHECK_NAMES)
        if n not in skipped
    )
    return f"{ctes} select * from ({rows}) c"


EMPTY = "(select count(*) filter (r = repeat('@', 64)) = 0 from sound)"
# The conversion quarantines a document without letters, so the table it validates has no row of it.
KEPT_ROWS = ROWS.replace("from all_pieces),", "from all_pieces where sequence <> ''),")
put("validate_table", check_rows(KEPT_ROWS, NOT_EMITTED["sound"], {"no_row_is_silently_empty": EMPTY}))
put(
    "validate_1000_wide",
    check_rows(
        f"{with_ctes('all_labelled')}, sound as (select * from all_labelled where sequence <> '')",
        NOT_EMITTED["sound"],
        {"no_row_is_silently_empty": "(select count(*) filter (sequence = '') = 0 from sound)"},
    ),
)
RANGE_OK = "(select count(*) filter (contains(f, '[')) = 0 from ranged)"
put(
    "validate_range_fault",
    check_rows(
        ROWS,
        ("label_dependent_checks_skipped", "padding_only_ever_trails_the_sequence", *DECODE),
        {"tokens_within_configured_range": RANGE_OK, "remaining_checks_skipped": RANGE_OK},
    ),
)
PAD_OK = f"(select count(*) filter ({INNER}) = 0 from padded)"
put(
    "validate_padding_fault",
    check_rows(
        ROWS,
        ("label_dependent_checks_skipped", *DECODE),
        {"padding_only_ever_trails_the_sequence": PAD_OK, "remaining_checks_skipped": PAD_OK},
    ),
)
SWAPPED = "swapped as (select *, case when ord % 41 = 0 then greatest(ord - 1, 0) else ord end::varchar as k from sound)"
KEYS_OK = "(select count(*) = count(distinct k) from swapped)"
SAME_OK = "(select count(*) filter (k <> sample_id) = 0 from swapped)"
put(
    "validate_key_fault",
    check_rows(
        f"{KEPT_ROWS}, {SWAPPED}",
        NOT_EMITTED["sound"],
        {
            "primary_key_unique": KEYS_OK,
            "samples_sidecar_sample_ids_match_table_order": SAME_OK,
            "content_hash_matches_the_table_on_disk": SAME_OK,
            "sampled_rows_decode_back_to_their_source_sequence": SAME_OK,
            "no_row_is_silently_empty": EMPTY,
        },
    ),
)
put(
    "validate_declared_fault",
    check_rows(
        KEPT_ROWS,
        NOT_EMITTED["sound"],
        {n: "false" for n in (
            "sidecar_counts_match_manifest", "samples_sidecar_content_hash_matches", "samples_sidecar_row_count_matches_manifest",
            "content_hash_matches_the_table_on_disk",
        )} | {"no_row_is_silently_empty": EMPTY},
    ),
)
TARGETS_OK = "(select count(*) filter (ord % 43 = 0) = 0 from sound)"
put(
    "validate_target_fault",
    check_rows(
        KEPT_ROWS,
        (
            "labels_only_documented_values", "remaining_checks_skipped", "conflicting_labels_on_identical_sequences_reported",
            "every_target_column_carries_at_least_one_positive", "a_single_target_column_has_at_least_two_classes",
        ),
        {n: TARGETS_OK for n in (
            "target_columns_exist", "all_target_columns_integer", "label_dependent_checks_skipped", "content_hash_matches_the_table_on_disk",
        )} | {"no_row_is_silently_empty": EMPTY},
    ),
)
put(
    "validate_label_fault",
    check_rows(
        KEPT_ROWS,
        NOT_EMITTED["sound"],
        {"labels_only_documented_values": "false", "content_hash_matches_the_table_on_disk": "false", "no_row_is_silently_empty": EMPTY,
         "a_single_target_column_has_at_least_two_classes": "false"},
    ),
)
put(
    "validate_zero_fault",
    check_rows(
        KEPT_ROWS,
        NOT_EMITTED["sound"],
        {"every_target_column_carries_at_least_one_positive": "false", "no_row_is_silently_empty": EMPTY,
         "a_single_target_column_has_at_least_two_classes": "false",
         "content_hash_matches_the_table_on_disk": "(select count(*) filter (even <> 0) = 0 from sound)"},
    ),
)
put(
    "validate_sidecar_fault",
    check_rows(
        f"{KEPT_ROWS}, {SWAPPED}",
        NOT_EMITTED["sound"],
        {n: SAME_OK for n in (
            "samples_sidecar_content_hash_matches", "samples_sidecar_sample_ids_match_table_order",
            "sampled_rows_decode_back_to_their_source_sequence",
        )} | {"samples_sidecar_sample_ids_unique": KEYS_OK, "no_row_is_silently_empty": EMPTY},
    ),
)
put(
    "validate_unprofiled",
    "select 0 as ordinal, 'loads' as name, count(*) > 0 as passed from documents union all select 1, 'sidecar_present_and_matches_header', false",
)
SHORT_OK = "(select count(*) filter (ord % 53 = 0) = 0 from sound)"
put(
    "validate_width_fault",
    check_rows(
        KEPT_ROWS,
        NOT_EMITTED["sound"],
        {"every_row_has_the_same_width": SHORT_OK, "no_row_is_silently_empty": EMPTY,
         # A cell of padding is lost from the row's text as well; one with a letter changes what the row decodes to.
         "content_hash_matches_the_table_on_disk": SHORT_OK,
         "sampled_rows_decode_back_to_their_source_sequence": "(select count(*) filter (ord % 53 = 0 and substr(r, 64) <> '@') = 0 from sound)"},
    ),
)
CELL_OK = "(select count(*) filter (ord % 59 = 0) = 0 from sound)"
put(
    "validate_cell_fault",
    check_rows(
        ROWS,
        (
            "label_dependent_checks_skipped", "every_row_has_the_same_width", "tokens_within_configured_range",
            "padding_only_ever_trails_the_sequence", *DECODE,
        ),
        {"all_position_columns_integer": CELL_OK, "remaining_checks_skipped": CELL_OK},
    ),
)
put(
    "compare_runs_differ",
    f"{ROWS}, {SWAPPED} select 'rerunning_with_the_same_config_is_byte_identical' as name, {SAME_OK} as passed",
)
put(
    "stored_checks",
    f"select k.kind, v.* from ({ORACLES['validate_table']}) v, (select 'json' as kind union all select 'table') k",
)
put(
    "validation_summary",
    f"""select bool_and(passed) as ok, count(*) as n_checks, count(*) filter (not passed) as n_failed
      from ({ORACLES['validate_padding_fault']}) v""",
)
put(
    "table_stats",
    f"""{ROWS} select count(*) as row_count, 66 as column_count, sum(64 - length(slice))::bigint as padding_cells from sound""",
)
put(
    "roundtrip_check",
    f"""{ROWS} select sample_id, sha256(replace(f, '@', '')) as found, sha256(slice) as recorded from padded
      where replace(f, '@', '') <> slice""",
)
put(
    "key_order_check",
    f"{ROWS}, {SWAPPED} select ord, k as table_key, sample_id as sidecar_key from swapped where k <> sample_id",
)

# ---- inventories and audit --------------------------------------------------------------------

put(
    "inventory_reconcile",
    f"""{with_ctes('expected', 'found')} select coalesce(e.path, f.path) as path, case when f.path is null then 'missing'
      when e.path is null then 'unexpected' when e.content_hash <> f.content_hash then 'hash_differs' else 'ok' end as status
      from expected e full outer join found f on e.path = f.path""",
)
AUDIT = f"""{with_ctes('labelled')},
  declared as (select s.source as source_key, coalesce(r.ready, false) as ready from (select distinct source from documents) s
    left join (select source, min(quality) = 0 as ready from labelled group by source) r on s.source = r.source),
  profiles as (select concat(source, '/', lang) as path, source as source_key, lang, count(*) as n, sum(n_chars) % 2 = 1 as odd
    from documents group by source, lang),
  findings as (
    select path, source_key, 'table loads and validates' as requirement, n <= 15 as passed from profiles
    union all select path, source_key, 'sample_id is present, non-null and unique', n <= 15 from profiles
    union all select path, source_key, 'exactly one target column', true from profiles
    union all select path, source_key, 'features are position columns in declared order and integer', true from profiles
    union all select path, source_key, 'encoding is the letter cipher with padding 0', not (lang = 'de' and odd) from profiles
    union all select path, source_key, 'label provenance matches the declaration', not (lang = 'fr' and odd) from profiles),
  rolled as (select requirement, case when bool_and(passed) then 'PASS' else 'FAIL' end as status, count(*) as n_tables,
    count(*) filter (not passed) as n_failed from findings group by requirement),
  coverage as (select d.source_key, case when ready then 'PASS' else 'BLOCKED_EXTERNAL' end as status,
    case when ready then 'native table present' else 'not ready; what exists is stale and does not count' end as detail,
    count(*) as n_tables from declared d join profiles p on d.source_key = p.source_key group by d.source_key, ready),
  report as (
    select case requirement when 'table loads and validates' then 1 when 'sample_id is present, non-null and unique' then 2
        when 'exactly one target column' then 3 when 'features are position columns in declared order and integer' then 4
        when 'encoding is the letter cipher with padding 0' then 5 else 6 end as ordinal, requirement, status from rolled
    union all select 7, concat('source coverage: ', source_key), status from coverage)"""
put("per_table_findings", f"{AUDIT} select * from findings")
put("requirement_rollup", f"{AUDIT} select * from rolled")
put(
    "provenance_check",
    f"""{AUDIT} select path, source_key, true as source_ok, true as url_ok, not (lang = 'fr' and odd) as licence_ok,
      true as description_ok, true as semantics_ok from profiles""",
)
put("source_coverage", f"{AUDIT} select * from coverage")
put("audit_report", f"{AUDIT} select * from report")
put(
    "audit_status",
    f"""{AUDIT} select case when bool_or(status = 'FAIL') then 'FAIL' when bool_and(status = 'PASS') then 'PASS' else 'INCOMPLETE' end
      as overall_status, count(*) as n_requirements from report""",
)
put("audit_status_counts", f"{AUDIT} select status, count(*) as n from report group by status")
put(
    "source_partition",
    """with done as (select distinct o_custkey as k from orders where o_orderstatus = 'F'),
      gated as (select distinct o_custkey as k from orders where o_orderstatus = 'P'), either as (select k from done union select k from gated)
      select k as source_key, 'both converted and gated' as problem from done where k in (select k from gated)
      union all select c_custkey, 'neither converted nor gated' from customer where c_custkey not in (select k from either)
      union all select k, 'not enabled' from either where k not in (select c_custkey from customer)""",
)
put(
    "index_coverage",
    """with want as (select l_orderkey, unnest(range(7))::int as i from (select distinct l_orderkey from lineitem) o),
      seen as (select l_orderkey, l_linenumber as i, count(*) as n from lineitem group by 1, 2)
      select coalesce(w.l_orderkey, s.l_orderkey) as l_orderkey, coalesce(w.i, s.i) as i,
        case when s.n is null then 'missing' when w.i is null then 'unexpected' else 'duplicate' end as problem
      from want w full outer join seen s on w.l_orderkey = s.l_orderkey and w.i = s.i
      where s.n is null or w.i is null or s.n > 1""",
)

# ---- files ------------------------------------------------------------------------------------

put("dataset_files", check_rows(ROWS, NOT_EMITTED["sound"], {"no_row_is_silently_empty": EMPTY}))
put("link_csv", f"{with_ctes('links')} select element, sample from links")
put(
    "malformed_csv",
    """select count(*) filter (doc_id % 13 = 0 or doc_id % 17 = 0) as malformed,
      count(*) filter (doc_id % 13 <> 0 and doc_id % 17 <> 0) as well_formed from documents""",
)
put(
    "lossless_csv",
    f"""{with_ctes('all_labelled')}, t as (select sample_id as s, lang from all_labelled where sequence <> '')
      select concat(' "', s, '",', chr(10), ' ') as sample_id,
        concat('  a\\n\\', lang, chr(13), chr(10), '"",', s, ' ', chr(9), chr(10), ' ') as note from t
      union all select 'failed', '0'""",
)
put(
    "fasta_sequences",
    f"""{with_ctes('elements')} select element, case when doc_id % 7 = 0 then left(sequence, length(sequence) // 2) else sequence end
      as sequence from elements""",
)
put("fasta_quarantine", f"{with_ctes('elements')} select concat('!broken ', doc_id::varchar) as line from elements where doc_id % 7 = 0")
put("pair_csv_drops", ORACLES["pair_drops"])
put("one_hot_csv", f"with {FIRST_EVENT} select user_id::varchar as user_id, concat('e_', k) as class from first_event")
put("sequence_dictionary", f"{with_ctes('dictionary')} select id, sequence from dictionary")
put("file_order", "select i as at, i as ord from (select unnest(range((select count(*) from lineitem))) as i) t")

# ---- whole folders ----------------------------------------------------------------------------

PIECES = f"{with_ctes('all_pieces', 'labelled_pieces')}, {CONVERTED}, whole as (select * from all_pieces where sequence <> '')"
TWO_CLASSES = "(select count(distinct quality) = 2 and count(distinct toxic) = 2 from conv)"


def audit_rows(loads: str, inventory: str) -> str:
    """The report over the written folder; ``loads`` and ``inventory`` are conditions over the data."""
    status = lambda ok: f"case when {ok} then 'PASS' else 'FAIL' end"
    rows = [
        (0, "run inventory is complete and current", status(inventory)), (1, "table loads and validates", status(loads)),
        (2, "sample_id is present, non-null and unique", "'PASS'"), (3, "exactly one target column", "'PASS'"),
        (4, "features are position columns in declared order and integer", "'PASS'"),
        (5, "encoding is the letter cipher with padding 0", "'PASS'"), (6, "label provenance matches the declaration", "'PASS'"),
        (7, "source coverage: documents", "'PASS'"), (7, "source coverage: labelled", "'PASS'"),
        (7, "source coverage: absent", "'BLOCKED_EXTERNAL'"),
    ]
    return f"{PIECES} " + " union all ".join(f"select {i} as ordinal, '{r}' as requirement, {s} as status" for i, r, s in rows)


UNSWAPPED = "(select count(*) filter (ord % 41 = 0 and substr(sequence, 1, 1) <> substr(sequence, 2, 1) and length(sequence) > 1) = 0 from whole)"
put("written_audit", audit_rows(TWO_CLASSES, "true"))
put("written_audit_swapped", audit_rows(f"{TWO_CLASSES} and {UNSWAPPED}", UNSWAPPED))
put(
    "projected_files",
    f"""{PIECES} select 'labelled' as source_key, 'PASS' as status, 'every index present and bound' as detail, 2::bigint as n_tables
      from (select count(*) as n from conv) c where n > 0""",
)
FOLDER_CHECKS = " union all ".join(
    f"""select p.path, {i} as ordinal, '{n}' as name, """
    + ("case when p.target = 'quality' then {0} when p.target = 'toxic' then {1} else true end".format(
        "(select count(distinct quality) = 2 from conv)", "(select count(distinct toxic) = 2 from conv)")
       if n == "a_single_target_column_has_at_least_two_classes"
       else "case when p.target = 'quality' then (select max(quality) > 0 from conv) when p.target = 'toxic' then (select max(toxic) > 0 from conv) else true end"
       if n == "every_target_column_carries_at_least_one_positive" else "true")
    + " as passed from p"
    for i, n in enumerate(CHECK_NAMES)
    if n not in NOT_EMITTED["sound"]
)
put(
    "folder_checks",
    f"""{PIECES}, p as (select 'documents_full' as path, '' as target union all select 'labelled_full/slug=quality', 'quality'
      union all select 'labelled_full/slug=toxic', 'toxic') {FOLDER_CHECKS} union all select 'torn', 0, 'loads', false""",
)
PLACED_ROW = row_digest("place::varchar", row_digest("sample_id", "even::varchar", "rpad(sequence, 64, '@')"))
put(
    "inventory_of_run",
    f"""{PIECES}, placed as (select *, row_number() over (order by ord) - 1 as place from whole), d as (select {PLACED_ROW} as h from placed)
      select 'documents_full' as path, {lanes('h')} as content_hash from d""",
)
put(
    "damaged_rows",
    f"""{PIECES} select sample_id, case when ord % 13 = 0 then 65 else 63 end as width, 64 as declared from whole
      where ord % 13 = 0 or ord % 17 = 0""",
)
put(
    "damaged_shape",
    f"""{PIECES} select (case when ord % 13 = 0 then 67 when ord % 17 = 0 then 65 else 66 end)::int as width, count(*) as n_rows
      from whole group by 1""",
)
put("keys_as_text", f"{PIECES} select sample_id, even::varchar as target from whole")

# ---- the other source shapes ------------------------------------------------------------------

put(
    "evidence_features",
    f"{with_ctes('dna')} select '1' as id, doc_id::varchar as name, b as sequence, lang as role, lang as call from dna",
)
put(
    "evidence_calls",
    f"""{with_ctes('dna')} select '1' as id, lang as call, count(*) as n from dna group by lang
      union all select '2', 'altered', count(*) from dna having count(*) > 0""",
)
put("evidence_detections", f"{with_ctes('dna')} select doc_id::varchar as sample, source as call from dna")
MEMBER = "concat('P', lpad(id, 8, '0'))"
put("membership_lists", f"{with_ctes('members')} select class, {MEMBER} as id from members")
put(
    "membership_list_problems",
    f"""{with_ctes('members')} select class as file, case when class = '5-LOW' then '<empty file>'
        else min(concat('bad ', id)) filter (id::int % 97 = 0) end as problem from members group by class
      having class = '5-LOW' or count(*) filter (id::int % 97 = 0) > 0""",
)
put(
    "values_csv",
    f"""{with_ctes('dna')} select doc_id::varchar as sequence_id, nullif(b, '') as sequence, lang as species_name, (doc_id % 37)::varchar as growth_rate
      from dna""",
)
put(
    "class_vocabulary",
    f"""with {FIRST_EVENT}, names as (select unnest(['e_click', 'e_error', 'e_purchase', 'e_signup', 'e_view']) as class)
      select n.class, count(k) as n from names n left join first_event f on n.class = concat('e_', k) group by n.class""",
)
put("one_target", f"{with_ctes('labelled')} select sample_id, toxic, 1 as n from labelled")
put(
    "index_gaps",
    """with want as (select l_orderkey, unnest(range(7))::bigint as i from (select distinct l_orderkey from lineitem) o),
      lost as (select w.* from want w anti join lineitem s on w.l_orderkey = s.l_orderkey and w.i = s.l_linenumber),
      runs as (select *, i - row_number() over (partition by l_orderkey order by i) as run from lost)
      select l_orderkey, min(i) as first, max(i) as last from runs group by l_orderkey, run""",
)
put(
    "membership_capped",
    f"""{with_ctes('members', 'dictionary')}, {SETS}, ranked as (select class, id, row_number() over (partition by class order by id) - 1 as depth
        from (select distinct class, id from members) m),
      turns as (select id, depth, class, row_number() over (partition by id order by depth, class) as rn from ranked),
      chosen as (select id from turns where rn = 1 order by depth, class limit 200)
      select v.id as sample_id, v.label from vectors v join chosen c on v.id = c.id join dictionary d on v.id = d.id where d.sequence <> ''""",
)

# ---- sampling and tallies ---------------------------------------------------------------------

BLOCKS = f"""with numbered as (select {LINE_ORDER}, row_number() over (order by {LINE_ORDER}) - 1 as position from lineitem),
  starts as (select i as block, round_even(i * (select count(*) from lineitem) / 9.0, 0)::bigint as block_start
    from (select unnest(range(1, 9))::int as i) b),
  sampled as (select block, block_start, position, {LINE_ORDER}, row_number() over (order by block, position) as taken
    from numbered join starts on position >= block_start and position < block_start + 100),
  kept as (select * from sampled where taken <= 750)"""
put("strided_blocks", f"{BLOCKS} select block, block_start, position, {LINE_ORDER} from kept")
put(
    "strided_file",
    """with n as (select count(*) as n from lineitem), starts as (select i as block, i * n * 13 // 9 as block_start, n from n, (select unnest(range(1, 9))::int as i) b),
      rows as (select block, block_start, n, unnest(range((block_start + 12) // 13, (block_start + 1300) // 13)) as k from starts)
      select block, block_start, lpad(k::varchar, 12, '0') as at from rows where k < n""",
)
put("block_provenance", f"{BLOCKS} select block, block_start, count(*) as rows from kept group by block, block_start")
put("prefix_sample", f"select {LINE_ORDER} from lineitem order by {LINE_ORDER} limit 100")
put("keyed_sample", "select doc_id, lang from documents order by sha256(concat('0:', doc_id::varchar)), doc_id limit 25")
put(
    "sample_tallies",
    """select 'c_mktsegment' as attribute, c_mktsegment as value, count(*) as n from customer group by c_mktsegment
      union all select 'c_nationkey', c_nationkey::varchar, count(*) from customer group by c_nationkey""",
)
put(
    "slugs",
    """select p_partkey, trim(regexp_replace(lower(concat_ws(' / ', p_name, p_brand, p_type)), '[^a-z0-9]+', '_', 'g'), '_') as slug
      from part""",
)
put(
    "text_projections",
    """select doc_id, substr(text, 1, 120) as clipped, concat(source, '::', doc_id::varchar) as composed, source as fragment,
      concat(lang, '__w', lpad(doc_id::varchar, greatest(2, length(doc_id::varchar))::int, '0')) as window_id from documents""",
)
