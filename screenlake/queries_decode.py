"""Queries over reads of two libraries with three and four cycles: decoding, what is kept of it, and its checks.

Reads are made from events, a molecule for each and one of 23 changes. Their definition is one SQL text that Spark and DuckDB both read, as is the definition of planted faults.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import counts, decode, samples, validate
from .plans.staging import scratch, staged
from .queries import _query, event_ids
from .sources import files

CYCLES, SAMPLES = 4, [f"S{k}" for k in range(4)]
SIZES = {"HP": [7, 8, 9], "OP": [11, 12, 13], "CP": [27, 28, 29], "CODON": [9, 10]}
LIBS = {"M3": 3, "M4": 4}
WINDOW = {"three": 75, "four": 85, "tolerance": 7}


def _seq(name: str, n: int) -> str:
    return hashlib.md5(name.encode()).hexdigest()[:n].translate(str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT"))


def _design() -> list[tuple[str, str, int, str, str]]:
    """type, lib_id, cycle, bb_id, seq: a head and an opening primer of all libraries, one opening primer of M4's own, three codons a cycle, of which one has ten bases.

    The last codon of M3's first cycle begins as the opening primer ends, so that both can overlap.
    """
    rows = [("HP", "", 0, "H", _seq("head", 8)), ("OP", "", 0, "O", _seq("open", 12)), ("OP", "M4", 0, "O4", _seq("open4", 12))]
    for lib, cycles in LIBS.items():
        rows.append(("CP", lib, 0, f"C{lib}", _seq(f"close{lib}", 28)))
        for c in range(1, cycles + 1):
            for k in range(3):
                seq = _seq(f"{lib}-{c}-{k}", 10 if (lib, c, k) == ("M4", 2, 1) else 9)
                seq = rows[1][4][-3:] + seq[3:] if (lib, c, k) == ("M3", 1, 2) else seq
                rows.append(("CODON", lib, c, f"{lib}B{c}{k}" + (f"_LIB{lib}" if k == 0 else ""), seq))
    return rows


_OF: dict[tuple, list] = {}
for _row in _design():
    _OF.setdefault(_row[:3], []).append(_row)


def _pick(lib: str, c: int) -> str:
    return f"CASE event_id % {c + 4} % 3 " + " ".join(f"WHEN {k} THEN '{r[4]}'" for k, r in enumerate(_OF["CODON", lib, c])) + " END"


def _parts_sql() -> str:
    """event_id, the lib's parts and the class of change."""
    both = lambda three, four: f"CASE WHEN event_id % 3 = 0 THEN {four} ELSE {three} END"
    hp, op, op4 = _OF["HP", "", 0][0][4], _OF["OP", "", 0][0][4], _OF["OP", "M4", 0][0][4]
    cols = [f"'{hp}' AS hp", f"{both(repr(op), f'CASE WHEN event_id % 2 = 0 THEN {op4!r} ELSE {op!r} END')} AS op"]
    cols += [f"{both(_pick('M3', c), _pick('M4', c))} AS c{c}" for c in (1, 2, 3)] + [f"{both(repr(''), _pick('M4', 4))} AS c4"]
    cols.append(f"{both(repr(_OF['CP', 'M3', 0][0][4]), repr(_OF['CP', 'M4', 0][0][4]))} AS cp")
    return f"SELECT event_id, event_id % 23 AS cls, {', '.join(cols)} FROM events"


_REV = "reverse(translate({}, 'ACGT', 'TGCA'))"
_OTHER = "translate({}, 'ACGT', 'CGTA')"
_OVERLAP = _OF["CODON", "M3", 1][2][4]
_CLASSES = {
    3: _REV.format("hp || op || body || cp"), 4: f"substr(hp, 1, 3) || {_OTHER.format('substr(hp, 4, 1)')} || substr(hp, 5) || op || body || cp", 5: "substr(hp, 1, 3) || substr(hp, 5) || op || body || cp",
    6: "hp || substr(op, 1, 5) || 'G' || substr(op, 6) || body || cp", 7: f"hp || op || body || substr(cp, 1, 9) || {_OTHER.format('substr(cp, 10, 1)')} || substr(cp, 11)",
    8: f"hp || op || c1 || substr(c2, 1, 4) || {_OTHER.format('substr(c2, 5, 1)')} || substr(c2, 6) || c3 || c4 || cp",
    9: f"hp || op || body || substr(cp, 1, 5) || {_OTHER.format('substr(cp, 6, 1)')} || substr(cp, 7, 10) || {_OTHER.format('substr(cp, 17, 1)')} || substr(cp, 18)",
    10: "hp || op || 'TAG' || body || cp", 11: "hp || op || 'TAGC' || body || cp", 12: f"hp || substr(op, 1, 9) || '{_OVERLAP}' || c2 || c3 || c4 || cp", 13: "hp || op || body || substr(cp, 1, 9)", 14: "hp || body || cp",
    15: "op || body || cp", 16: "hp || op || body || cp || hp || op || body", 17: "hp || op || substr(c1, 1, 4) || 'N' || substr(c1, 6) || c2 || c3 || c4 || cp", 18: "'NNN' || hp || op || body || cp || 'NN'",
    19: _REV.format("hp || op || body || substr(cp, 1, 11) || substr(cp, 13)"), 20: "hp || op || c1 || 'A' || c2 || 'CC' || c3 || c4 || 'G' || cp",
}
READS_SQL = (
    "SELECT 'S' || CAST(CAST(floor(event_id / 23) AS BIGINT) % 4 AS STRING) AS sample, event_id AS read_id, CASE cls "
    + " ".join(f"WHEN {k} THEN {v}" for k, v in _CLASSES.items())
    + f" ELSE hp || op || body || cp END AS seq FROM (SELECT *, c1 || c2 || c3 || c4 AS body FROM ({_parts_sql()}) p) b"
)


def tags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_design(), "type string, lib_id string, cycle int, bb_id string, seq string")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READS_SQL.replace("FROM events", "FROM {events}"), events=event_ids(spark, sf_dir))


def _variants(s: str) -> set[str]:
    n = len(s)
    out = {s[:i] + b + s[i + 1 :] for i in range(n) for b in "ACGT"} | {s[:i] + s[i + 1 :] for i in range(n)}
    return (out | {s[:i] + b + s[i:] for i in range(1, n) for b in "ACGT" if not (i == 1 and b == s[0]) and not (i == n - 1 and b == s[-1])}) - {s}


def _done_sql() -> str:
    rows = [(*r[:4], k, m) for r in _design() for k, m in [(r[4], 0), *[(v, 1) for v in sorted(_variants(r[4])) if r[0] != "CODON"]]]
    values = ", ".join(f"('{a}', '{b}', {c}, '{d}', '{e}', {f})" for a, b, c, d, e, f in rows)
    lengths = ", ".join(f"({n})" for n in sorted({n for v in SIZES.values() for n in v}))

    def candidates(lib: str, cycles: int) -> str:
        ends = ["(op.pos + op.len)", *[f"(c{k}.pos + c{k}.len)" for k in range(1, cycles + 1)]]
        joins = " ".join(f"JOIN h c{k} ON c{k}.read_id = cp.read_id AND c{k}.dir = cp.dir AND c{k}.lib_id = cp.lib_id AND c{k}.type = 'CODON' AND c{k}.cycle = {k} AND abs(c{k}.pos - {ends[k - 1]}) <= 3" for k in range(1, cycles + 1))
        gaps = " + ".join(f"abs({'cp' if k > cycles else f'c{k}'}.pos - {ends[k - 1]})" for k in range(1, cycles + 2))
        own = lambda k, f: f"c{k}.{f}" if k <= cycles else "NULL"
        chain = ", ".join([*[f"{own(k, 'pos')} AS c{k}_pos" for k in range(1, 5)], *[f"{own(k, 'bb_id')} AS bb{k}" for k in range(1, 5)], *[f"{own(k, 'len')} AS c{k}_len" for k in range(1, 5)]])
        anchor = ", ".join(f"{a}.{f} AS {a}_{f}" for a in ("cp", "op", "hp") for f in ("pos", "len", "miss"))
        return f"""SELECT cp.read_id, cp.dir, cp.lib_id, {anchor}, op.lib_id AS op_lib, hp.lib_id AS hp_lib, {gaps} AS penalty, {chain}, {cycles} AS cycles
        FROM h cp JOIN h op ON op.read_id = cp.read_id AND op.dir = cp.dir AND op.type = 'OP' AND op.lib_id IN ('', cp.lib_id) AND op.pos < cp.pos
        JOIN h hp ON hp.read_id = cp.read_id AND hp.dir = cp.dir AND hp.type = 'HP' AND hp.lib_id IN ('', cp.lib_id) AND hp.pos < op.pos AND abs(op.pos - hp.pos - hp.len) <= 3
        {joins} WHERE cp.type = 'CP' AND cp.lib_id = '{lib}' AND abs(cp.pos - {ends[-1]}) <= 3"""

    best = "dir, cp_miss, cp_pos DESC, lib_id, cp_len, op_miss, op_pos DESC, CASE WHEN op_lib = lib_id THEN 0 ELSE 1 END, op_len, hp_miss, hp_pos DESC, CASE WHEN hp_lib = lib_id THEN 0 ELSE 1 END, hp_len, penalty, " + ", ".join(f"c{k}_pos, c{k}_len, bb{k}" for k in range(1, 5))
    return f"""rd AS ({READS_SQL}),
    pat AS (SELECT * FROM (VALUES {values}) v(type, lib_id, cycle, bb_id, kmer, miss)),
    tried AS (SELECT * FROM rd WHERE abs(length(seq) - 75) <= 7 OR abs(length(seq) - 85) <= 7),
    di AS (SELECT read_id, 0 AS dir, seq FROM tried UNION ALL SELECT read_id, 1, {_REV.format("seq")} FROM tried),
    wi AS (SELECT read_id, dir, i - 1 AS pos, substr(seq, i, k) AS kmer FROM di, generate_series(1, 100) g(i), (VALUES {lengths}) l(k) WHERE i + k - 1 <= length(seq)),
    h AS (SELECT read_id, dir, pos::INTEGER AS pos, pat.*, length(kmer)::INTEGER AS len FROM wi JOIN pat USING (kmer)),
    ca AS ({" UNION ALL ".join(candidates(lib, n) for lib, n in LIBS.items())}),
    done AS (SELECT * EXCLUDE (r, op_lib, hp_lib) FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY {best}) AS r FROM ca) WHERE r = 1),
    an AS (SELECT read_id, max((type = 'CP')::INTEGER) AS cp, max((type = 'OP')::INTEGER) AS op, max((type = 'HP')::INTEGER) AS hp FROM h WHERE dir = 0 GROUP BY 1),
    oc AS (SELECT rd.sample, rd.read_id, CASE WHEN d.read_id IS NOT NULL THEN 'decoded' WHEN t.read_id IS NULL THEN 'len_out_of_range' WHEN coalesce(cp, 0) = 0 THEN 'no_cp' WHEN coalesce(op, 0) = 0 THEN 'no_op' WHEN coalesce(hp, 0) = 0 THEN 'no_hp' ELSE 'codon_fail' END AS outcome,
      CASE WHEN d.read_id IS NOT NULL THEN 1 WHEN t.read_id IS NULL THEN 0 ELSE coalesce(cp, 0) END AS cp_found, CASE WHEN d.read_id IS NOT NULL THEN 1 WHEN t.read_id IS NULL THEN 0 ELSE coalesce(op, 0) END AS op_found, CASE WHEN d.read_id IS NOT NULL THEN 1 WHEN t.read_id IS NULL THEN 0 ELSE coalesce(hp, 0) END AS hp_found
      FROM rd LEFT JOIN tried t USING (read_id) LEFT JOIN done d ON d.read_id = rd.read_id LEFT JOIN an ON an.read_id = rd.read_id)"""


_RECORD = [c for a in ("hp", "op", "cp") for c in (f"{a}_pos", f"{a}_len", f"CASE {a}_miss WHEN 0 THEN 'PERF' ELSE 'MISS' END AS {a}_qual", f"substr(o, {a}_pos + 1, {a}_len) AS {a}_seq")]
_RECORD += [c for k in range(1, 5) for c in (f"c{k}_pos", f"c{k}_len", f"substr(o, c{k}_pos + 1, c{k}_len) AS c{k}_seq", f"bb{k} AS c{k}_bb_id")]
_DECODE = "WITH " + _done_sql()
_RECORDS = f"{_DECODE}, rec AS (SELECT sample, read_id, length(seq) AS read_len, seq AS read_seq, CASE dir WHEN 1 THEN 'revcomp' ELSE 'forward' END AS direction, lib_id, cycles, cycles || '_' || bb1 || '_' || bb2 || '_' || bb3 || '_' || coalesce(bb4, 'NA') AS id, {', '.join(_RECORD)} FROM (SELECT done.*, rd.sample, rd.seq, CASE dir WHEN 1 THEN {_REV.format('seq')} ELSE seq END AS o FROM done JOIN rd USING (read_id)))"


def _outcomes(spark, sf_dir):
    """All reads, the decoded ones, and every read's outcome."""
    r = staged(reads(spark, sf_dir))
    kind = counts.length_class(F.length("seq"), **WINDOW)
    done, every = decode.outcomes(r, staged(decode.patterns(tags(spark))), CYCLES, SIZES, counts.length_passes(kind))
    return r, done, every


def _records(spark, sf_dir):
    return decode.records(_outcomes(spark, sf_dir)[1], CYCLES)


@_query(f"{_DECODE} SELECT * FROM done")
def decode_mixed_cycles(spark, sf_dir):
    return _outcomes(spark, sf_dir)[1].drop("sample", "seq")


@_query(f"{_DECODE} SELECT sample, lib_id, cycles, count(*) AS n FROM done JOIN rd USING (read_id) GROUP BY ALL")
def mixed_cycle_distribution(spark, sf_dir):
    r, done, _ = _outcomes(spark, sf_dir)
    return decode.cycle_distribution(done)


_GAPS = [("hp_op", "op_pos - hp_pos - hp_len"), ("op_c1", "c1_pos - op_pos - op_len"), *[(f"c{k}_c{k + 1}", f"c{k + 1}_pos - c{k}_pos - c{k}_len") for k in (1, 2, 3)], ("c4_cp", "CASE cycles WHEN 4 THEN cp_pos - c4_pos - c4_len END"), ("c_last_cp", "CASE cycles WHEN 3 THEN cp_pos - c3_pos - c3_len END")]


@_query(f"{_DECODE}, gp AS ({' UNION ALL '.join(f'SELECT sample, lib_id, {n!r} AS metric, {e} AS gap FROM done JOIN rd USING (read_id)' for n, e in _GAPS)}) SELECT sample, lib_id, metric, count(*) AS n, round(avg(gap), 6) AS mean, round(stddev_pop(gap), 6) AS sd, min(gap)::DOUBLE AS least, max(gap)::DOUBLE AS greatest FROM gp WHERE gap IS NOT NULL GROUP BY ALL")
def gap_stats_by_sample(spark, sf_dir):
    r, done, _ = _outcomes(spark, sf_dir)
    g = decode.gap_stats(done, CYCLES, by=("sample", "lib_id"))
    return g.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@_query(f"{_DECODE} SELECT sample, lib_id, count(*) AS n, " + ", ".join(f"count(*) FILTER ({a}_miss = {m}) AS {a}_{w}" for a in ("hp", "op", "cp") for m, w in ((0, "perf"), (1, "miss"))) + ", count(*) FILTER (dir = 0) AS forward_reads, count(*) FILTER (dir = 1) AS revcomp_reads FROM done JOIN rd USING (read_id) GROUP BY ALL")
def anchor_quality_by_sample(spark, sf_dir):
    r, done, _ = _outcomes(spark, sf_dir)
    return decode.anchor_quality(done, ("sample", "lib_id"))


@_query(f"{_DECODE} SELECT sample, lib_id, cycle, bb_id, count(*) AS n FROM ({' UNION ALL '.join(f'SELECT read_id, lib_id, {k} AS cycle, bb{k} AS bb_id FROM done' for k in range(1, 5))}) JOIN rd USING (read_id) WHERE bb_id IS NOT NULL GROUP BY ALL")
def bb_frequency_by_sample(spark, sf_dir):
    r, done, _ = _outcomes(spark, sf_dir)
    return decode.block_counts(done, CYCLES, ("sample", "lib_id"))


@_query(f"{_DECODE} SELECT rd.sample, 0::BIGINT AS order_violation, count(*) FILTER (NOT cp_len BETWEEN 28 AND 29) AS cp_len_odd, coalesce(sum({' + '.join(f'coalesce((c{k}_len <> 9)::BIGINT, 0)' for k in range(1, 5))}), 0)::BIGINT AS codon_len_odd FROM rd LEFT JOIN done USING (read_id) GROUP BY ALL")
def codon_length_checks(spark, sf_dir):
    """A primer that lost a base counts as odd here, and so do codons of ten bases."""
    r, done, every = _outcomes(spark, sf_dir)
    return decode.quality_checks(done, every, 9, 28, 29, CYCLES)


@_query(f"{_DECODE}, g AS (SELECT l.lib_id, s.sample FROM (SELECT unnest(['M3', 'M4', 'M5']) AS lib_id) l, (SELECT DISTINCT sample FROM rd) s), c AS (SELECT sample, lib_id, count(*) AS n FROM done JOIN rd USING (read_id) GROUP BY ALL), w AS (SELECT sample, count(*) AS total FROM rd GROUP BY 1) SELECT g.lib_id, g.sample, coalesce(n, 0) AS n, coalesce(round(coalesce(n, 0)::DOUBLE / nullif(sum(coalesce(n, 0)) OVER (PARTITION BY g.sample), 0), 6), 0) AS ratio, round(coalesce(n, 0)::DOUBLE / total, 6) AS ratio_raw FROM g LEFT JOIN c ON c.lib_id = g.lib_id AND c.sample = g.sample JOIN w ON w.sample = g.sample")
def lib_sample_shares(spark, sf_dir):
    """With a library that nothing was decoded to."""
    r, done, _ = _outcomes(spark, sf_dir)
    libs, names = spark.createDataFrame([("M3",), ("M4",), ("M5",)], "lib_id string"), spark.createDataFrame([(s,) for s in SAMPLES], "sample string")
    return counts.shares(done, libs, names, r.groupBy("sample").agg(F.count(F.lit(1)).alias("total")))


@_query(f"WITH rd AS ({READS_SQL}), l AS (SELECT sample, length(seq) AS n FROM rd) SELECT sample, count(*) FILTER (abs(n - 75) > 7 AND abs(n - 85) > 7) AS kept_outside, count(*) FILTER (abs(n - 75) <= 7 OR abs(n - 85) <= 7) AS kept_inside, count(*) FILTER (abs(n - 85) <= 7) AS kept_four FROM l GROUP BY 1")
def length_policies(spark, sf_dir):
    """What each policy of the length filter lets through."""
    r = reads(spark, sf_dir)
    kind = lambda mode: counts.length_class(F.length("seq"), **WINDOW, mode=mode)
    kept = {"kept_outside": (kind("both"), "reject_inside"), "kept_inside": (kind("both"), "reject_outside"), "kept_four": (kind("4"), "reject_outside")}
    return r.groupBy("sample").agg(*[F.count_if(counts.length_passes(k, p)).alias(n) for n, (k, p) in kept.items()])


@_query(f"{_RECORDS} SELECT * FROM rec")
def decoded_sink(spark, sf_dir):
    """Decoded reads, written by sample and read again."""
    r, done, every = _outcomes(spark, sf_dir)
    rows, failed, path = decode.records(done, CYCLES), decode.failures(every), scratch(spark, "reads")
    files.write_reads(rows, failed, path)
    return files.read_reads(spark, path, files.DECODED, rows.schema)


@_query(f"{_DECODE} SELECT sample, read_id, length(seq) AS read_len, seq AS read_seq, outcome AS reason, cp_found, op_found, hp_found FROM oc JOIN rd USING (sample, read_id) WHERE outcome <> 'decoded'")
def undecoded_sink(spark, sf_dir):
    r, done, every = _outcomes(spark, sf_dir)
    rows, failed, path = decode.records(done, CYCLES), decode.failures(every), scratch(spark, "reads")
    files.write_reads(rows, failed, path)
    return files.read_reads(spark, path, files.UNDECODED, failed.schema)


@_query(f"{_DECODE}, s AS (SELECT sample, read_id, outcome, row_number() OVER (PARTITION BY sample, outcome ORDER BY md5('2026:' || read_id), read_id) AS r FROM oc) SELECT sample, outcome, read_id FROM s WHERE r <= 5")
def sampled_reads(spark, sf_dir):
    """Five reads of each outcome in each sample, the same under any partitioning."""
    every = staged(_outcomes(spark, sf_dir)[2].select("sample", "read_id", "outcome"))
    return samples.bottom_k(every, ("sample", "outcome"), 5, 2026, "read_id").select("sample", "outcome", "read_id")


# Planted faults -------------------------------------------------------------------------------------------------------

_FAULTS = {
    "read_len": {1: "read_len + 1"}, "hp_pos": {2: "-1", 3: "hp_pos + 1"}, "hp_seq": {4: "NULL", 21: "'ACGTACGT'"}, "op_pos": {5: "500"}, "op_seq": {22: "'ACGTACGTACGT'"}, "c2_seq": {6: "'AAAAAAAAA'"}, "c2_pos": {7: "NULL", 14: "c1_pos"},
    "cycles": {8: "2", 9: "NULL"}, "lib_id": {10: "'LX'", 11: "CASE lib_id WHEN 'M3' THEN 'M4' ELSE 'M3' END"}, "cp_len": {12: "20"}, "c1_len": {13: "8"}, "c1_pos": {14: "c2_pos", 23: "500"}, "direction": {15: "CASE direction WHEN 'forward' THEN 'revcomp' ELSE 'forward' END"},
    "cp_seq": {16: "reverse(cp_seq)"}, "id": {17: "'3_X_Y_Z_NA'", 18: "'7' || substr(id, 2)", 19: "cycles || '_A_LIBQ_B_C_NA'", 24: "cycles || '_A_B_C_NA'"}, "cp_pos": {20: "hp_pos", 25: "NULL"}, "c3_pos": {26: "c3_pos - 4"},
}


def _faulty(columns: list[str], extra: str = "") -> str:
    cols = [f"CASE read_id % 31 {' '.join(f'WHEN {k} THEN {v}' for k, v in _FAULTS[c].items())} ELSE {c} END AS {c}" if c in _FAULTS else c for c in columns]
    return f"SELECT {', '.join(cols)} FROM {extra}"


_COLUMNS = ["sample", "read_id", "read_len", "read_seq", "direction", "lib_id", "cycles", "id", *[f"{a}_{f}" for a in ("hp", "op", "cp") for f in ("pos", "len", "qual", "seq")], *[f"c{k}_{f}" for k in range(1, 5) for f in ("pos", "len", "seq", "bb_id")]]
_FAULTY = f"{_RECORDS}, bad AS ({_faulty(_COLUMNS, 'rec')}), ba AS (SELECT *, CASE direction WHEN 'revcomp' THEN {_REV.format('read_seq')} ELSE read_seq END AS o, coalesce(cycles, 0) AS cy, CASE lib_id WHEN 'M3' THEN 3 WHEN 'M4' THEN 4 END AS ex FROM bad)"


def _faulty_records(spark, sf_dir):
    return spark.sql(_faulty(_COLUMNS, "{rec}"), rec=_records(spark, sf_dir))


def _rule_sql() -> str:
    """The rules in DuckDB: a list of errors for each row."""
    gone = lambda a: f"({a}_pos IS NULL OR {a}_len IS NULL OR {a}_seq IS NULL)"
    out = lambda a: f"({a}_pos < 0 OR {a}_pos + {a}_len > length(o))"
    place = lambda a, name, mark="true": f"CASE WHEN NOT ({mark}) THEN NULL WHEN {gone(a)} THEN 'missing_{a}' WHEN {out(a)} THEN '{name}_pos_oob' WHEN substr(o, {a}_pos + 1, {a}_len) <> {a}_seq THEN '{name}_seq_mismatch' END"
    fits = lambda kind, c, shared: f"EXISTS (SELECT 1 FROM pat WHERE pat.type = '{kind}' AND pat.kmer = ba.{c} AND pat.lib_id IN (ba.lib_id{", \'\'" if shared else ""}))"
    codon = lambda k: f"CASE WHEN cy >= {k} AND NOT {gone(f'c{k}')} AND NOT {out(f'c{k}')} THEN {{'p': c{k}_pos, 'n': c{k}_len, 'f': {fits('CODON', f'c{k}_seq', False)}}} END"
    kept = lambda a, f: f"CASE WHEN NOT {gone(a)} THEN {a}_{f} END"
    simple = [
        "CASE WHEN read_len <> length(read_seq) THEN 'read_len_mismatch' END", "CASE WHEN cycles IS NULL THEN 'cycles_parse' END", "CASE WHEN cy > 0 AND ex IS NULL THEN 'lib_unknown' WHEN cy > 0 AND cy <> ex THEN 'cycles_mismatch' END",
        *[place(a, a.upper()) for a in ("hp", "op", "cp")], *[place(f"c{k}", f"c{k}", f"cy >= {k}") for k in range(1, 5)],
        "CASE WHEN hpp > opp THEN 'order_violation' END", "CASE WHEN v[1].p < opp THEN 'order_violation' END", "CASE WHEN v[-1].p > cpp THEN 'order_violation' END",
        "CASE WHEN abs(opp - hpp - hpn) > 3 THEN 'gap_HP_OP' END", "CASE WHEN abs(v[1].p - opp - opn) > 3 THEN 'gap_OP_C1' END", "CASE WHEN abs(cpp - v[-1].p - v[-1].n) > 3 THEN 'gap_C_last_CP' END",
        *[f"CASE WHEN len(v) > {i} AND v[{i + 1}].p < v[{i}].p THEN 'order_violation' END" for i in (1, 2, 3)], *[f"CASE WHEN len(v) > {i} AND abs(v[{i + 1}].p - v[{i}].p - v[{i}].n) > 3 THEN 'gap_C{i}_C{i + 1}' END" for i in (1, 2, 3)],
        "CASE WHEN len(list_filter(v, lambda c: c.n <> 9)) > 0 THEN 'codon_len_not9' END", "CASE WHEN NOT cpn BETWEEN 27 AND 29 THEN 'cp_len_out_of_27_29' END",
        *[f"CASE WHEN NOT {gone(a)} AND NOT fit_{a} THEN '{a.upper()}_not_in_lib' END" for a in ("hp", "op", "cp")], "CASE WHEN ex IS NOT NULL AND len(list_filter(v, lambda c: NOT c.f)) > 0 THEN 'codon_not_in_lib' END",
    ]
    return f""", lk AS (SELECT *, list_filter([{', '.join(codon(k) for k in range(1, 5))}], lambda c: c IS NOT NULL) AS v, {', '.join(f"{kept(a, f)} AS {a}{f[0] if f == 'pos' else 'n'}" for a in ('hp', 'op', 'cp') for f in ('pos', 'len'))},
      {', '.join(f"{fits(a.upper(), f'{a}_seq', a != 'cp')} AS fit_{a}" for a in ('hp', 'op', 'cp'))} FROM ba),
    er AS (SELECT *, list_filter([{', '.join(simple)}], lambda e: e IS NOT NULL) AS errors FROM lk)"""


_RULES = _rule_sql()


@_query(f"{_FAULTY}{_RULES}, lo AS (SELECT sample, unnest(list_concat(['n', CASE WHEN len(errors) = 0 THEN 'pass' ELSE 'fail' END], errors)) AS \"check\" FROM er) SELECT sample, \"check\", count(*) AS n FROM lo GROUP BY ALL")
def decode_validation(spark, sf_dir):
    table = staged(decode.patterns(tags(spark)))
    return validate.error_counts(validate.validated(_faulty_records(spark, sf_dir), table, CYCLES))


_BACK = [f"CASE WHEN substr(oo, {a}_pos + 1, {a}_len) <> {a}_seq THEN 'seq_mismatch_{a.upper()}' END" for a in ("hp", "op", "cp", "c1", "c2", "c3", "c4")]
_BACK += ["CASE WHEN cy > 0 AND ip[1] <> cy::VARCHAR THEN 'cycles_mismatch' END", "CASE WHEN " + " OR ".join(f"coalesce(c{k}_bb_id, 'NA') <> replace(ip[{k + 1}], '~LIB', '_LIB')" for k in range(1, 5)) + " THEN 'bb_id_mismatch' END", "CASE WHEN len(il) = 0 THEN 'lib_suffix_missing' WHEN len(il) > 1 OR il[1] <> lib_id THEN 'lib_id_mismatch' END"]


@_query(f"{_FAULTY}, ib AS (SELECT ba.*, CASE direction WHEN 'revcomp' THEN {_REV.format('rd.seq')} ELSE rd.seq END AS oo, string_split(replace(id, '_LIB', '~LIB'), '_') AS ip FROM ba JOIN rd USING (read_id)), ic AS (SELECT *, list_distinct(list_filter(list_transform(ip[2:], lambda x: CASE WHEN contains(x, '~LIB') THEN split_part(x, '~LIB', 2) END), lambda x: x IS NOT NULL)) AS il FROM ib) SELECT mismatch, count(*) AS n FROM (SELECT unnest(list_filter([{', '.join(_BACK)}], lambda m: m IS NOT NULL)) AS mismatch FROM ic) GROUP BY ALL")
def read_back(spark, sf_dir):
    found = validate.read_back(_faulty_records(spark, sf_dir), reads(spark, sf_dir), CYCLES)
    return found.select(F.explode("mismatches").alias("mismatch")).groupBy("mismatch").agg(F.count(F.lit(1)).alias("n"))


@_query(f"{_FAULTY}, k AS (SELECT lib_id, id, sample, count(*) AS kept FROM rec GROUP BY ALL), c AS (SELECT lib_id, id, sample, count(*) AS counted FROM ba GROUP BY ALL) SELECT lib_id, id, sample, coalesce(kept, 0) AS kept, coalesce(counted, 0) AS counted FROM k FULL JOIN c USING (lib_id, id, sample) WHERE coalesce(kept, 0) <> coalesce(counted, 0)")
def recount_against_matrix(spark, sf_dir):
    """Faulty records against the matrix that was made of the sound ones."""
    rows = _records(spark, sf_dir)
    bad = spark.sql(_faulty(_COLUMNS, "{rec}"), rec=rows)
    return validate.recounted(bad, counts.matrix(rows, SAMPLES), SAMPLES)


_KINDS = ("no_cp", "no_op", "no_hp", "codon_fail", "len_out_of_range")


@_query(
    f"{_FAULTY}{_RULES}, st AS (SELECT sample, count(*)::DOUBLE AS total_reads, (count(*) FILTER (outcome <> 'len_out_of_range'))::DOUBLE AS length_passed_reads, (count(*) FILTER (outcome = 'decoded'))::DOUBLE AS decoded_reads, {', '.join(f'(count(*) FILTER (outcome = {k!r}))::DOUBLE AS {k}' for k in _KINDS)} FROM oc GROUP BY 1), "
    "va AS (SELECT sample, count(*) AS validated, count(*) FILTER (len(errors) = 0) AS passed FROM er WHERE sample <> 'S3' GROUP BY 1) "
    f"SELECT sample, total_reads, length_passed_reads, decoded_reads, {', '.join(_KINDS)}, coalesce(validated, 0)::DOUBLE AS validated, coalesce(passed, 0)::DOUBLE AS passed, CASE sample WHEN 'S2' THEN 'stats' WHEN 'S3' THEN 'validation' ELSE '' END AS absent, CASE sample WHEN 'S1' THEN 'total_reads' ELSE '' END AS conflicts FROM st LEFT JOIN va USING (sample)"
)
def validation_table(spark, sf_dir):
    """Three tables of counts by sample; one sample is missing from two of them, and two tables disagree on a number."""
    r, done, every = _outcomes(spark, sf_dir)
    every = staged(every)
    stats_ = decode.sample_stats(every).drop("decode_rate_pct").withColumn("total_reads", F.col("total_reads") - (F.col("sample") == "S1").cast("long"))
    summary = decode.decoding_summary(every).drop("order_violation").join(decode.sample_stats(every).select("sample", "length_passed_reads"), "sample")
    rows = decode.records(done, CYCLES)
    bad = spark.sql(_faulty(_COLUMNS, "{rec}"), rec=rows).filter("sample != 'S3'")
    checked = validate.validated(bad, staged(decode.patterns(tags(spark))), CYCLES)
    checks = checked.groupBy("sample").agg(F.count(F.lit(1)).alias("validated"), F.count_if(F.size("errors") == 0).alias("passed"))
    tables = {"summary": summary, "stats": stats_.filter("sample != 'S2'"), "validation": checks}
    return validate.assembled(tables).select("sample", "total_reads", "length_passed_reads", "decoded_reads", *_KINDS, "validated", "passed", "absent", "conflicts")
