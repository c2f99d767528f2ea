"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from baobab.llm import decontaminate, hard_negatives, merkle, mixing, preferences, sharding

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(regexp_split_to_array({_LOWER}, '{_GAP}'), lambda x: x <> '')"


def shard_sql(shards: list[str]) -> str:
    table = sharding.fill_table(shards, sharding.TABLE_SIZE)
    return f"""
    WITH slots AS (SELECT {table} AS shard_of)
    SELECT doc_id, shard_of[(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 't' || coalesce(text, ''))), 1, 15))
                             ::BIGINT % {sharding.TABLE_SIZE}) + 1] AS shard
    FROM documents, slots"""


def decontaminate_sql() -> str:
    size, share = decontaminate.SIZE, decontaminate.SHARE
    return f"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item, list_slice(w, i, i + least({size}, len(w)) - 1) AS win
                FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - {size - 1}))) AS i
                      FROM items WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
    docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
    starts AS (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lengths WHERE len(w) >= n),
    hits AS (SELECT DISTINCT r, i, n, item FROM starts JOIN windows ON list_slice(w, i, i + n - 1) = win),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit
                FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
    found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def mixing_sql() -> str:
    weights = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(mixing.WEIGHTS))
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
    WITH sized AS (
      SELECT doc_id, source, coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '{word}')) AS BIGINT) AS size,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS DOUBLE) AS symbols FROM documents),
    keyed AS (
      SELECT doc_id, source, size,
             -ln((CAST(('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 't' || t)), 1, 13))::BIGINT AS DOUBLE)
                  + 0.5) / {float(2 ** 52)})
             / greatest(1e-6, CASE WHEN size = 0 THEN 1.0 ELSE
                 (CASE WHEN length(t) / size >= 3 AND length(t) / size <= 15 THEN 1.0 ELSE 0.5 END)
                 / (1.0 + 10.0 * symbols / size) END) AS key
      FROM sized),
    sources AS (
      SELECT source, sum(size) AS s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}
             {weights} END AS w FROM keyed GROUP BY source),
    ranked AS (
      SELECT *, {mixing.MAX_EPOCHS} * s AS cap, row_number() OVER (ORDER BY {mixing.MAX_EPOCHS} * s / w, source NULLS LAST) AS k FROM sources),
    rates AS (
      SELECT k, w, cap, greatest(0, {mixing.BUDGET} * (sum(s) OVER ()) - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rate
      FROM ranked),
    rate AS (SELECT first(rate ORDER BY k) AS rate FROM rates WHERE rate * w < cap),
    targets AS (SELECT source, s, CAST(coalesce(least(cap, (SELECT rate FROM rate) * w), cap) AS DOUBLE) AS target FROM ranked),
    plan AS (SELECT source, s, target, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS epochs FROM targets),
    tied AS (SELECT source, key, sum(size) AS size FROM keyed GROUP BY source, key),
    summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key) AS upto FROM tied),
    border AS (
      SELECT p.source, max(key) AS border FROM summed t JOIN plan p ON t.source IS NOT DISTINCT FROM p.source
      WHERE p.target - p.epochs * p.s > 0 AND upto - size / 2 <= p.target - p.epochs * p.s GROUP BY p.source)
    SELECT doc_id, k.size, CAST(p.s AS BIGINT) AS source_size, p.target,
           CAST(k.size * (epochs + CASE WHEN coalesce(key <= border, false) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
    LEFT JOIN border b ON k.source IS NOT DISTINCT FROM b.source"""


def preferences_sql() -> str:
    """The echo pairs are equal up to the last answer, if that answer differs from its echo."""
    safe = f"replace({{}}, '{preferences.OPEN}', '< |')"
    head = f"'{preferences.OPEN}' || {safe.format('role')} || '{preferences.CLOSE}' || chr(10)"
    body = f"{safe.format('text')} || '{preferences.END}' || chr(10)"
    return f"""
    WITH turns AS (
      SELECT conv_id, row_number() OVER o AS k, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             lag(text) OVER o AS before, max(CASE WHEN role = '{preferences.TRAINED}' THEN turn END) OVER (PARTITION BY conv_id) AS answer
      FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST)),
    a AS (SELECT conv_id, k, role, text FROM turns),
    b AS (SELECT conv_id, k, role, CASE WHEN turn = answer AND role = '{preferences.TRAINED}' AND before IS NOT NULL
                                        THEN before ELSE text END AS text FROM turns WHERE answer IS NULL OR turn <= answer),
    cut AS (SELECT a.conv_id, coalesce(min(CASE WHEN b.k IS NULL OR a.role <> b.role OR a.text <> b.text THEN a.k END) - 1, count(*)) AS n
            FROM a LEFT JOIN b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.k = b.k GROUP BY a.conv_id),
    pieces AS (
      SELECT side, s.conv_id, k, n, role, {head} AS head, {body} AS body
      FROM (SELECT 'a' AS side, * FROM a UNION ALL SELECT 'b', * FROM b) s JOIN cut c ON s.conv_id IS NOT DISTINCT FROM c.conv_id),
    placed AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY side, conv_id ORDER BY k) AS stop FROM pieces),
    sides AS (
      SELECT side, conv_id, any_value(n) AS n, coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k <= n), '') AS prompt,
             coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k > n), '') AS rest,
             coalesce(string_agg((stop - length(body)) || ':' || stop, ',' ORDER BY k) FILTER (k > n AND role = '{preferences.TRAINED}'), '') AS mask
      FROM placed GROUP BY side, conv_id)
    SELECT x.conv_id, CAST(x.n AS BIGINT) AS n_prompt_turns, x.prompt, x.rest AS chosen, coalesce(y.rest, '') AS rejected,
           x.mask AS chosen_mask, coalesce(y.mask, '') AS rejected_mask,
           x.mask <> '' AND coalesce(y.mask, '') <> '' AND x.rest <> coalesce(y.rest, '') AS usable
    FROM (FROM sides WHERE side = 'a') x LEFT JOIN (FROM sides WHERE side = 'b') y ON x.conv_id IS NOT DISTINCT FROM y.conv_id"""


def merkle_sql(levels: int = 12) -> str:
    """Every level of both trees as a table of its own, up to 3^12 leaves a source."""
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    others = " || ".join(field(c) for c in merkle.FIELDS[:-1])
    steps = ["""
    byte AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS crc
             FROM (SELECT unnest(generate_series(0, 255)) AS n)),
    crcs AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                                                   lambda a, b: xor(crc[(xor(a, b) & 255) + 1], a >> 8))) AS crc_of FROM documents, byte)""",
             f"""
    leaves AS (SELECT doc_id, source, sha256({others} || {field('text')}) AS leaf,
                      sha256({others} || {field("CASE WHEN crc_of % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS now FROM crcs)""",
             """
    p0 AS (SELECT *, now AS f, '' AS proof, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)""",
             "\n    s0 AS (SELECT g, i, n, leaf AS h FROM p0)"]

    def tree(s: str, p: str, place: str) -> None:
        for k in range(levels):
            size = f"ceil(n / {3 ** k}.0)"
            steps.append(f"""
    {s}{k + 1} AS (SELECT g, i // 3 AS i, any_value(n) AS n, CASE WHEN any_value({size}) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
                   FROM {s}{k} GROUP BY g, i // 3),
    {s}w{k} AS (SELECT g, i, coalesce(lag(h, 2) OVER o, '') || coalesce(lag(h) OVER o, '') AS l, coalesce(lead(h) OVER o, '') || coalesce(lead(h, 2) OVER o, '') AS r
                FROM {s}{k} WINDOW o AS (PARTITION BY g, i // 3 ORDER BY i)),
    {p}{k + 1} AS (SELECT {p}{k}.* REPLACE (CASE WHEN {size} > 1 THEN sha256(l || f || r) ELSE f END AS f, proof || l || r AS proof)
                   FROM {p}{k} JOIN {s}w{k} ON {place.format(p=f"{p}{k}", s=f"{s}w{k}", k=3 ** k)})""")

    tree("s", "p", "{p}.g = {s}.g AND {p}.i // {k} = {s}.i")
    steps.append(f"""
    t0 AS (SELECT 0 AS g, g AS i, count(*) OVER () AS n, h FROM s{levels}),
    q0 AS (SELECT p{levels}.* REPLACE ((SELECT count(*) FROM t0) AS n), h AS subroot FROM p{levels} JOIN t0 ON p{levels}.g = t0.i)""")
    tree("t", "q", "{p}.g // {k} = {s}.i")
    return f"""WITH {','.join(steps)}
    SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM q{levels}, t{levels}"""


def hard_negatives_sql() -> str:
    low, high = hard_negatives.LOW, hard_negatives.HIGH
    return f"""
    WITH kept AS (
      SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor({hard_negatives.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
    scores AS (
      SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND (a.label <> b.label OR a.vec_id IS DISTINCT FROM b.vec_id)),
    positives AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS k FROM scores WHERE same)
      WHERE k <= {hard_negatives.POSITIVES}),
    ranked AS (
      SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.r, p.k ORDER BY n.score DESC, n.vec_id NULLS LAST) AS INTEGER) AS rank
      FROM positives p JOIN scores n ON p.r = n.r AND NOT n.same AND {low} * p.score <= 100 * n.score AND 100 * n.score <= {high} * p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {hard_negatives.NEGATIVES}"""


ORACLE: dict[str, str] = {
    "op2_sharding": shard_sql([f"shard-{i:03d}" for i in range(64)]),
    "op3_decontaminate": decontaminate_sql(),
    "op7_mixing": mixing_sql(),
    "op9_preferences": preferences_sql(),
    "op11_merkle_manifest": merkle_sql(),
    "op12_hard_negatives": hard_negatives_sql(),
}
