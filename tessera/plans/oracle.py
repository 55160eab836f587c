"""DuckDB SQL for every registered query (the independent oracle).

The fixture recipes are restated as CTEs over the pre-registered driver
views.  The whitespace set and the clean-up table are written out here, so
that a wrong one in the library shows.
"""

from __future__ import annotations

from tessera.plans.queries import (
    BATCH, CORPUS_LENGTH, PROFILE_CHUNK, RETURN_SEQUENCES, DEVICES_PER_NODE, EPOCHS, EVERY_N, MAX_EPOCHS, PAIR_LENGTH, PATIENCE,
    PREPARED_EPOCH, PREPARED_RANK, PREPARED_SPLIT, SEED, WORLD)

# fixed values: code points that Python's str.strip() removes
WHITESPACE = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198,
              8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288)
# fixed values: blanks that decoding takes out
CLEAN_UP = ((" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"), (" n't", "n't"), (" 'm", "'m"),
            (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"))
# fixed values: version patterns and error text of a driver banner
DRIVER_PATTERN, CUDA_PATTERN = "Driver Version: (.+?) ", "CUDA Version:(.*) "
BANNER_ERROR = "nvidia-smi output is unexpected"
WS = "concat(" + ", ".join(f"chr({c})" for c in WHITESPACE) + ")"

F1 = """f1 as (
  select doc_id, source as grp,
         case when doc_id%10=8 then 'validation' when doc_id%10=9 then 'test' else 'train' end as split,
         text || case doc_id%5
           when 0 then chr(10)||'  Heading '||doc_id||':  '||chr(10)
           when 1 then chr(10)||chr(10)||chr(9)||' '||chr(10)
           when 2 then chr(13)||chr(10)||'tail '||doc_id||chr(160)
           when 3 then chr(10)||'stop'||chr(65306)
           else '' end as text
  from documents)"""

F2 = """f2 as (
  select u.conv_id*1000+u.turn as row_id, u.text as source_text, a.text as target_text
  from conversations u
  join conversations a on a.conv_id=u.conv_id and a.turn=u.turn+1
  where u.role='user' and a.role='assistant')"""

F4 = """f4 as (
  select user_id%20 as run_id, (event_id%4)::INT as rank, ((event_id//20)%6)::INT as epoch,
         row_number() over (partition by user_id%20, event_id%4, (event_id//20)%6, event_type='error'
                            order by event_id)-1 as step,
         case when event_type='error' then 'val' else 'train' end as phase,
         value/100 as loss, ts
  from events)"""

def _f3_sql() -> str:
    return """f3 as (
  with t as (
    select 'host'||(user_id%3) as source, event_id, ts, value,
           row_number() over (partition by user_id%3 order by ts, event_id)-1 as line_no
    from events)
  select source, line_no,
    case
      when source='host2' and line_no=(select max(line_no) from t t2 where t2.source='host2')
        then '00000000:00:01.0, 2024/0'
      when source='host1' and line_no%2=0
        then concat_ws(', ', '00000000:00:01.0',
               strftime(ts,'%Y/%m/%d %H:%M:%S')||'.'||lpad((event_id%1000)::varchar,3,'0'),
               (floor(value)::int%101)::varchar, ((event_id*37)%16160)::varchar, '16160')
      else concat_ws(', ',
             '00000000:00:0'||(case when source='host1' then 2 else event_id%2 end)::varchar||'.0',
             strftime(ts,'%Y/%m/%d %H:%M:%S')||'.'||lpad((event_id%1000)::varchar,3,'0'),
             (floor(value)::int%101)::varchar, ((event_id*37)%16160)::varchar, '16160',
             ((event_id*7)%1000/10.0)::varchar, (1000+(event_id*13)%60000)::varchar, '61440')
    end as line
  from t)"""


F3 = _f3_sql()

DOC_LINES = f"""doc_lines as (
  select doc_id, grp, split, line_no, text from (
    select doc_id, grp, split, (i - 1)::BIGINT as line_no, trim(p[i], {WS}) as text from (
      select doc_id, grp, split, p, unnest(generate_series(1, len(p))) as i
      from (select doc_id, grp, split, string_split(text, chr(10)) as p from f1))
  ) where text <> '' and not ends_with(text, ':'))"""


def byte_ids(t: str, k: int) -> str:
    return (f"list_transform(range(0, least(octet_length(encode({t})), {k})), "
            f"lambda i: ('0x' || substr(hex(encode({t})), 2*i+1, 2))::INTEGER + 3)")


def rep(v: int, n: str) -> str:
    return f"repeat([{v}]::INTEGER[], {n})"


def cleanup(t: str) -> str:
    out = t
    for a, b in CLEAN_UP:
        a_sql = a.replace("'", "''")
        b_sql = b.replace("'", "''")
        out = f"replace({out}, '{a_sql}', '{b_sql}')"
    return out


def byte_prefix(t: str, k: int) -> str:
    """The longest prefix of whole characters within ``k`` UTF-8 bytes."""
    return f"left({t}, len(list_filter(range(1, length({t})+1), lambda i: strlen(left({t}, i)) <= {k})))"


ORACLE: dict[str, str] = {}

ORACLE["corpus_lines_document"] = f"""with {F1}, {DOC_LINES}
select doc_id, line_no, text from doc_lines"""

ORACLE["corpus_lines_group"] = f"""with {F1},
docs as (
  select split, grp, doc_id, len(string_split(text, chr(10))) - 1 as nl,
         coalesce(sum(len(string_split(text, chr(10))) - 1) over (
           partition by split, grp order by doc_id rows between unbounded preceding and 1 preceding), 0) as off
  from f1 where text is not null),
g as (select split, grp, string_split(string_agg(text, '' order by doc_id), chr(10)) as parts
      from f1 where text is not null group by split, grp),
lines as (select split, grp, i - 1 as k, parts[i] as raw
          from (select split, grp, parts, unnest(generate_series(1, len(parts))) as i from g)),
firsts as (select split, grp, min(doc_id) as d0 from docs group by split, grp),
placed as (
  select l.split, l.grp, case when l.k = 0 then f.d0 else d.doc_id end as doc_id,
         (case when l.k = 0 then 0 else l.k - d.off end)::BIGINT as line_no,
         trim(l.raw, {WS}) as text
  from lines l
  join firsts f on f.grp = l.grp and f.split = l.split
  left join docs d on d.grp = l.grp and d.split = l.split and l.k > d.off and l.k <= d.off + d.nl and l.k > 0)
select split, grp, doc_id, line_no, text from placed where text <> '' and not ends_with(text, ':')"""

ORACLE["causal_encode"] = f"""with {F1}, {DOC_LINES},
e as (select doc_id, line_no, {byte_ids('text', CORPUS_LENGTH)} as ids from doc_lines)
select doc_id, line_no,
  list_concat(ids, {rep(1, f'{CORPUS_LENGTH} - len(ids)')}) as input_ids,
  list_concat({rep(1, 'len(ids)')}, {rep(0, f'{CORPUS_LENGTH} - len(ids)')}) as attention_mask,
  list_concat(ids, {rep(1, f'{CORPUS_LENGTH} - len(ids)')}) as labels
from e"""


def _pair_seq2seq(col: str, n: int) -> str:
    return f"list_concat({byte_ids(col, n - 1)}, [1]::INTEGER[])"


ORACLE["pair_encode"] = f"""with {F2},
e as (select row_id, {_pair_seq2seq('source_text', PAIR_LENGTH)} as s,
             {_pair_seq2seq('target_text', PAIR_LENGTH)} as t from f2)
select row_id,
  list_concat(s, {rep(0, f'{PAIR_LENGTH} - len(s)')}) as source_text_input_ids,
  list_concat({rep(1, 'len(s)')}, {rep(0, f'{PAIR_LENGTH} - len(s)')}) as source_text_attention_mask,
  list_concat(t, {rep(-100, f'{PAIR_LENGTH} - len(t)')}) as labels,
  list_concat({rep(1, 'len(t)')}, {rep(0, f'{PAIR_LENGTH} - len(t)')}) as labels_attention_mask
from e"""

ORACLE["pair_encode_left"] = f"""with {F2},
e as (select row_id, list_concat([2]::INTEGER[], {byte_ids('source_text', PAIR_LENGTH - 1)}) as s,
             list_concat([2]::INTEGER[], {byte_ids('target_text', PAIR_LENGTH - 1)}) as t from f2)
select row_id,
  list_concat({rep(1, f'{PAIR_LENGTH} - len(s)')}, s) as source_text_input_ids,
  list_concat({rep(0, f'{PAIR_LENGTH} - len(s)')}, {rep(1, 'len(s)')}) as source_text_attention_mask,
  list_concat({rep(1, f'{PAIR_LENGTH} - len(t)')}, t) as labels,
  list_concat({rep(0, f'{PAIR_LENGTH} - len(t)')}, {rep(1, 'len(t)')}) as labels_attention_mask
from e"""

ORACLE["decode_roundtrip"] = f"""with {F2}
select row_id,
  {cleanup(byte_prefix('source_text', PAIR_LENGTH - 1))} as source_decoded,
  {cleanup(byte_prefix('target_text', PAIR_LENGTH - 1))} as target_decoded
from f2"""

ORACLE["corpus_chain_splits"] = f"""with {F1}, {DOC_LINES}
select case split when 'validation' then 'evaluation' else split end as split,
       count(*) as n_lines, sum(least(strlen(text), {CORPUS_LENGTH}))::BIGINT as n_tokens
from doc_lines where split in ('train', 'validation') group by 1"""


SHUFFLED = f"""s as (
  select e.epoch::INT as epoch, row_id,
         row_number() over (partition by e.epoch
           order by md5(concat_ws(':', '{SEED}', e.epoch::VARCHAR, row_id::VARCHAR)), row_id) - 1 as pos
  from f2, (select unnest(range({EPOCHS})) as epoch) e)"""

RANKED = f"""c as (select epoch, count(*) as n from s group by epoch),
x as (select epoch, n, unnest(range(n, ((n + {WORLD} - 1) // {WORLD}) * {WORLD})) as p from c),
allr as (
  select epoch, row_id, pos, false as is_padding from s
  union all
  select s.epoch, s.row_id, x.p as pos, true as is_padding
  from x join s on s.epoch = x.epoch and s.pos = (x.p - x.n) % x.n),
ranked as (
  select epoch, row_id, pos, is_padding, (pos % {WORLD})::INT as rank, pos // {WORLD} as pos_in_rank,
         ((pos % {WORLD}) // {DEVICES_PER_NODE})::INT as node_rank, (pos % {WORLD} % {DEVICES_PER_NODE})::INT as local_rank
  from allr)"""

ORACLE["shuffle_epoch"] = f"""with {F2}, {SHUFFLED}
select epoch, row_id, pos from s"""

def _feistel_keys() -> str:
    """The two numbers of each epoch's six rounds, as a list of SQL rows."""
    rows = []
    for epoch in range(EPOCHS):
        x = SEED * 1000003 + epoch * 8191 + 12345
        for i in range(6):
            x = (x % 2147483647 * 48271 + 11) % 2147483647
            k0 = x
            x = (x * 48271 + 11) % 2147483647
            rows.append(f"({epoch}, {i}, {k0}::BIGINT, {x}::BIGINT)")
    return ", ".join(rows)


# six rounds of (l, r) -> (r, l + f(r)) over halves below a and b; from n on once more
ORACLE["shuffle_permuted"] = f"""with recursive {F2},
x as (select row_id, row_number() over (order by row_id) - 1 as ordinal, count(*) over () as n from f2),
ab as (select *, floor(sqrt(n - 1))::BIGINT + 1 as a from x),
h as (select *, (n + a - 1) // a as b from ab),
k(epoch, i, k0, k1) as (values {_feistel_keys()}),
w as (
  select epoch, row_id, ordinal, n, a, b, 0 as step, ordinal // b as l, ordinal % b as r from h, range({EPOCHS}) e(epoch)
  union all
  select w.epoch, row_id, ordinal, n, a, b, step + 1, r,
         (l + list_reduce([r % 2147483647 * k0 + k1, k0, k1], lambda y, c: (y % 2147483647) * (y % 2147483647) + c) % 2147483647)
           % case when step % 2 = 0 then a else b end
  from w join k on k.epoch = w.epoch and k.i = step % 6
  where not (step > 0 and step % 6 = 0 and l * b + r < n))
select epoch::INT as epoch, row_id, ordinal, l * b + r as pos, ordinal as row_at_pos
from w where step > 0 and step % 6 = 0 and l * b + r < n"""

ORACLE["shuffle_null_keys"] = f"""with {F2},
x as (select row_id, case when row_id % 3 <> 0 then (row_id % 3)::VARCHAR end as split, md5('{SEED}:0:' || row_id) as key from f2)
select split, 0 as epoch, row_id, row_number() over (partition by split order by key, row_id) - 1 as pos,
       count(*) over (partition by split) as n_rows
from x"""

ORACLE["rank_shards"] = f"""with {F2}, {SHUFFLED}, {RANKED}
select * from ranked"""

ORACLE["rank_batches"] = f"""with {F2}, {SHUFFLED}, {RANKED}
select epoch, rank, pos_in_rank // {BATCH} as batch_id, count(*) as n_rows,
       list(row_id order by pos_in_rank) as row_ids
from ranked group by 1, 2, 3"""


def r4(x: str) -> str:
    return f"round_even(({x})*10000.0::DOUBLE, 0)/10000.0::DOUBLE"


def r12(x: str) -> str:
    return f"round_even(({x})*1000000000000.0::DOUBLE, 0)/1000000000000.0::DOUBLE"


def r11(x: str) -> str:
    return f"round_even(({x})*100000000000.0::DOUBLE, 0)/100000000000.0::DOUBLE"


def exact_mean4(x: str) -> str:
    """Half-even rounding to 4 places of the exact mean of ``x`` taken at 10
    decimal places, in integer arithmetic (DuckDB divides decimals as
    doubles)."""
    num = f"(sum(({x})::DECIMAL(18,10)) * 10000000000)::HUGEINT"
    den = f"(count(({x})::DECIMAL(18,10)) * 1000000)::HUGEINT"
    q = f"(abs({num}) // {den})"
    r = f"(abs({num}) % {den})"
    k = f"({q} + case when 2 * {r} > {den} or (2 * {r} = {den} and {q} % 2 = 1) then 1 else 0 end)"
    return f"(sign({num}) * {k})::DOUBLE / 10000.0::DOUBLE"


def py_float_text(x: str) -> str:
    d = f"rtrim(({x})::DECIMAL(38,4)::VARCHAR, '0')"
    return f"(case when ends_with({d}, '.') then {d} || '0' else {d} end)"


ORACLE["epoch_loss_by_rank"] = f"""with {F4}
select run_id, rank, epoch, phase, {exact_mean4('loss')} as avg_loss, count(*) as n_steps
from f4 group by 1, 2, 3, 4"""

# plain double means, but for the runs of small losses, where ties are common
ORACLE["epoch_loss_diverged"] = f"""with {F4},
x as (
  select run_id, rank, epoch, phase, case
           when run_id % 5 = 1 and step % 7 = 3 then 'nan'::DOUBLE
           when run_id % 5 = 2 and step % 7 = 3 then 'inf'::DOUBLE
           when run_id % 5 = 3 and step % 2 = 1 then '-inf'::DOUBLE
           when run_id % 5 = 4 then floor(loss * 8) / 8.0::DOUBLE + 2.5e8::DOUBLE else loss end as loss from f4),
e as (select run_id, rank, epoch, phase, count(*) as n_steps, case
        when bool_or(not isfinite(loss)) or run_id % 5 = 4 then round_even(avg(loss), 4)
        else {exact_mean4('case when isfinite(loss) and run_id % 5 <> 4 then loss end')} end as m
      from x group by 1, 2, 3, 4)
select run_id, rank, epoch, phase, n_steps,
       case when isfinite(m) then {py_float_text('m')} else m::VARCHAR end as avg_loss_text
from e"""

ORACLE["loss_across_ranks"] = f"""with {F4},
steps as (
  select run_id, phase, epoch, 'step' as level, step, {r12('avg(loss)')} as mean_loss, count(*) as n
  from f4 where phase <> 'train' or (step + 1) % {EVERY_N} = 0 group by 1, 2, 3, 5),
per_rank as (select run_id, phase, epoch, rank, avg(loss) as m from f4 group by 1, 2, 3, 4),
epochs as (
  select run_id, phase, epoch, 'epoch' as level, NULL::BIGINT as step, {r12('avg(m)')} as mean_loss, count(*) as n
  from per_rank group by 1, 2, 3)
select * from steps union all select * from epochs"""

ORACLE["early_stop"] = f"""with {F4},
mon as (
  select run_id, epoch, avg(m) as value
  from (select run_id, epoch, rank, avg(loss) as m from f4 where phase = 'val' group by 1, 2, 3)
  group by 1, 2),
x as (
  select *, row_number() over (partition by run_id order by epoch) as i,
         min(case when isfinite(value) then value end) over (partition by run_id order by epoch
             rows between unbounded preceding and 1 preceding) as prev
  from mon),
y as (select *, (isfinite(value) and (prev is null or value < prev)) as imp from x),
z as (select *, max(case when imp then i end) over (partition by run_id order by epoch
             rows between unbounded preceding and current row) as last from y),
st as (select *, (not isfinite(value)) or (i - coalesce(last, 0) >= {PATIENCE}) as stop from z),
t as (select *, min(case when stop then i end) over (partition by run_id) as si,
             count(*) over (partition by run_id) as n from st)
select run_id, max(case when i = si then epoch end) as stop_epoch,
       arg_max(epoch, case when imp then i end) as best_epoch,
       {r12('arg_max(value, case when imp then i end)')} as best_value,
       max(n)::BIGINT as n_epochs
from t where si is null or i <= si group by run_id"""

ORACLE["checkpoint_names"] = f"""with {F4},
per as (
  select run_id, rank, epoch,
         {exact_mean4("case when phase = 'train' then loss end")} as t,
         {exact_mean4("case when phase = 'val' then loss end")} as v,
         count(case when phase = 'train' then 1 end) as nt
  from f4 group by 1, 2, 3),
c as (select *, last_value(v ignore nulls) over (partition by run_id, rank order by epoch
        rows between unbounded preceding and current row) as vc from per)
select run_id, rank, epoch,
       'outputs/T5-epoch-' || epoch || '-train-loss-' || {py_float_text('t')}
       || '-val-loss-' || coalesce({py_float_text('vc')}, 'None') as checkpoint
from c where nt > 0"""

ORACLE["checkpoint_last_epoch"] = f"""with {F4},
per as (
  select run_id, rank, epoch,
         {exact_mean4("case when phase = 'train' then loss end")} as t,
         {exact_mean4("case when phase = 'val' then loss end")} as v,
         count(case when phase = 'train' then 1 end) as nt
  from f4 group by 1, 2, 3),
c as (select *, last_value(v ignore nulls) over (partition by run_id, rank order by epoch
        rows between unbounded preceding and current row) as vc from per)
select run_id, rank, epoch,
       'outputs/Mistral-epoch-' || epoch || '-train-loss-' || {py_float_text('t')}
       || '-val-loss-' || coalesce({py_float_text('vc')}, 'None') as checkpoint
from c where nt > 0 and epoch = {MAX_EPOCHS - 1}"""

ORACLE["argmax_accuracy"] = """with f5 as (select vec_id as example_id, embedding as logits, label from embeddings),
h as (select case when list_position(logits, list_max(logits)) - 1 = label then 1 else 0 end as hit from f5)
select count(*) as n_examples, sum(hit)::BIGINT as n_correct, avg(hit::DOUBLE) as accuracy from h"""

ORACLE["run_elapsed"] = f"""with {F4},
r as (select run_id, min(ts) as start_ts, max(ts) as end_ts from f4 group by 1)
select run_id, start_ts, end_ts, (epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0::DOUBLE as elapsed_sec,
       printf('%.2f min', ((epoch_us(end_ts) - epoch_us(start_ts)) / 1000000.0::DOUBLE) / 60.0::DOUBLE) as elapsed_text
from r"""


NUM = ["gpu_utilization", "gpu_memory_used", "gpu_memory_total", "cpu_utilization", "ram_used", "ram_total"]
TEXT_FIELDS = ["timestamp"] + NUM
SPLIT3 = f"""p as (select source, line_no, list_transform(string_split(line, ','), lambda x: trim(x, {WS})) as f from f3)"""


def _fields(mode: str) -> str:
    """Text fields per kept line, as ``fields``."""
    base = "select source, line_no, f[1] as device, split_part(f[2], '.', 1) as timestamp, f[3] as gpu_utilization, f[4] as gpu_memory_used, f[5] as gpu_memory_total"
    if mode == "strict":
        return f"""{SPLIT3},
cut as (select source, min(line_no) as c from p where len(f) <> 8 group by source),
fields as ({base}, f[6] as cpu_utilization, f[7] as ram_used, f[8] as ram_total
  from p left join cut using (source) where (c is null or line_no < c) and len(f) = 8)"""
    if mode == "skip":
        return f"""{SPLIT3},
fields as ({base}, f[6] as cpu_utilization, f[7] as ram_used, f[8] as ram_total from p where len(f) = 8)"""
    return f"""{SPLIT3},
k as (select *, first_value(case when len(f) = 8 then [f[6], f[7], f[8]] end ignore nulls) over (
        partition by source order by line_no rows between current row and unbounded following) as host
      from p where len(f) in (5, 8)),
fields as ({base}, host[1] as cpu_utilization, host[2] as ram_used, host[3] as ram_total from k)"""


def _parsed(mode: str) -> str:
    nums = ", ".join(f"try_cast({c} as DOUBLE) as {c}" for c in NUM)
    return f"""{_fields(mode)},
parsed as (select source, line_no, device, try_strptime(timestamp, '%Y/%m/%d %H:%M:%S') as ts, {nums} from fields)"""


for _mode in ("strict", "skip", "backfill"):
    ORACLE[f"monitor_parse_{_mode}"] = f"""with {F3}, {_parsed(_mode)}
select * from parsed"""

ORACLE["device_max_report"] = f"""with {F3}, {_parsed('skip')},
m as (select source, device, max(gpu_utilization) as max_gpu, max(gpu_memory_used) as max_gpu_memory,
             max(cpu_utilization) as max_cpu, max(ram_used) as max_ram from parsed group by 1, 2)
select *, printf('%2.1f%%', max_gpu) as max_gpu_text, printf('%dMB', trunc(max_gpu_memory)::BIGINT) as max_gpu_memory_text,
       printf('%2.1f%%', max_cpu) as max_cpu_text, printf('%dMB', trunc(max_ram)::BIGINT) as max_ram_text
from m"""

ORACLE["device_percent_series"] = f"""with {F3}, {_parsed('skip')},
firsts as (select source, device, arg_min(ts, line_no) as first_ts, arg_min(gpu_memory_total, line_no) as fm,
                  arg_min(ram_total, line_no) as fr from parsed group by 1, 2),
x as (select p.*, (epoch_us(p.ts) - epoch_us(f.first_ts)) / 1000000.0::DOUBLE as seconds_since_start,
             100.0::DOUBLE * p.gpu_memory_used / nullif(p.gpu_memory_total, 0) as gpu_memory_pct,
             100.0::DOUBLE * p.ram_used / nullif(p.ram_total, 0) as ram_pct, f.fm, f.fr
      from parsed p join firsts f using (source, device))
select source, device, line_no, ts, seconds_since_start, gpu_utilization, gpu_memory_pct, cpu_utilization, ram_pct,
       (gpu_memory_pct / 100.0::DOUBLE) * fm as gpu_memory_mb, (ram_pct / 100.0::DOUBLE) * fr as ram_mb
from x"""

ORACLE["device_percent_inverse"] = f"""with s as ({ORACLE["device_percent_series"]})
select source, device, line_no, {r11('gpu_memory_pct')} as gpu_memory_pct_back, {r11('ram_pct')} as ram_pct_back
from s"""

_series = ", ".join(f"'{c}': list({c} order by line_no)" for c in TEXT_FIELDS)
ORACLE["device_profile_nested"] = f"""with {F3}, {_fields('skip')},
per_dev as (select source, line_no // {PROFILE_CHUNK} as chunk, device, {{{_series}}} as s
            from fields group by 1, 2, 3)
select source, chunk, to_json(map_from_entries(list({{'k': device, 'v': s}} order by device))) as profile_json
from per_dev group by 1, 2"""

ORACLE["device_inventory"] = f"""with {F3}, {_fields('skip')},
inv as (select distinct source, device, gpu_memory_total from fields)
select source, 'GPU ' || source as name, device as device_id, gpu_memory_total || ' MiB' as memory,
       count(*) over (partition by source) as n_devices
from inv"""

VERSIONS = f"""b as (select source, case when source = 'host2'
        then 'NVIDIA-SMI has failed because it couldn''t communicate with the driver.'
        else '| NVIDIA-SMI 470.57.02    Driver Version: 470.57.' || (count(*) % 100) || '    CUDA Version: 11.' || (count(*) % 10) || '     |' end as text
      from f3 group by source),
v as (select source, regexp_matches(text, '{DRIVER_PATTERN}') and regexp_matches(text, '{CUDA_PATTERN}') as ok,
             trim(regexp_extract(text, '{DRIVER_PATTERN}', 1), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) as d,
             trim(regexp_extract(text, '{CUDA_PATTERN}', 1), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) as c
      from b)"""

ORACLE["driver_versions"] = f"""with {F3},
{VERSIONS}
select source, case when ok then d end as driver_version, case when ok then c end as cuda_version,
       case when not ok then '{BANNER_ERROR}' end as error
from v"""


# ---- step 6: user functions (same results as the native operators) ----------
ORACLE["batch_mapper"] = ORACLE["corpus_lines_document"]
ORACLE["user_tokenizer"] = ORACLE["pair_encode"]
ORACLE["user_tokenizer_decode"] = f"select row_id, source_decoded from ({ORACLE['decode_roundtrip']})"
ORACLE["metric_callback"] = ORACLE["argmax_accuracy"]
ORACLE["batch_generate"] = f"""with {F2}
select row_id, s.seq_no::INTEGER as seq_no, {cleanup(byte_prefix('source_text', PAIR_LENGTH - 1))} as text
from f2, (select unnest(range({RETURN_SEQUENCES})) as seq_no) s"""

# ---- step 7 ------------------------------------------------------------------
ORACLE["csv_roundtrip"] = f"""with {F2}
select row_id, source_text, target_text from f2"""

ORACLE["csv_quoted_lines"] = f"""with {F2}
select row_id, replace(source_text, ' ', ' "q",' || chr(10)) as source_text, target_text from f2"""

ORACLE["prepared_dataset"] = f"""with {F2}, {SHUFFLED}, {RANKED}
select r.epoch, r.rank, r.pos_in_rank, r.pos_in_rank // {BATCH} as batch_id, r.row_id, r.is_padding,
       (least(strlen(f2.source_text), {PAIR_LENGTH - 1}) + 1)::INTEGER as source_len
from ranked r join f2 using (row_id)"""

ORACLE["prepared_rank_shard"] = f"""with {F2}, {SHUFFLED}, {RANKED},
enc as ({ORACLE["pair_encode"].replace(f"with {F2},", "with")})
select r.pos_in_rank, r.pos_in_rank // {BATCH} as batch_id, enc.*
from ranked r join enc using (row_id)
where r.epoch = {PREPARED_EPOCH} and r.rank = {PREPARED_RANK}
  and case when r.row_id % 10 = 8 then 'validation' else 'train' end = '{PREPARED_SPLIT}'"""

# the same rows whether the payload is stored once or per epoch
ORACLE["prepared_store"] = ORACLE["prepared_dataset"]
ORACLE["prepared_store_rank"] = ORACLE["prepared_rank_shard"]

# S5 and S6 read back from files give the same rows as the in-table forms
ORACLE["inventory_file_source"] = ORACLE["device_inventory"]
ORACLE["banner_file_source"] = ORACLE["driver_versions"]

ORACLE["split_corpus_source"] = f"""with {F1}
select doc_id, grp, split, text from f1"""

ORACLE["monitor_text_source"] = f"""with {F3}
select source, line_no, line from f3"""

ORACLE["monitor_growing_source"] = ORACLE["monitor_text_source"]

# ---- step 8: streams equal the batch aggregate when nothing is late ----------
ORACLE["stream_device_max"] = f"""with {F3}, {_parsed('skip')}
select time_bucket(interval '10 minutes', ts) as window_start,
       time_bucket(interval '10 minutes', ts) + interval '10 minutes' as window_end,
       source, device, max(gpu_utilization) as max_gpu, max(gpu_memory_used) as max_gpu_memory,
       max(cpu_utilization) as max_cpu, max(ram_used) as max_ram
from parsed where ts is not null group by 1, 2, 3, 4"""

# late rows change nothing
ORACLE["stream_device_max_late"] = ORACLE["stream_device_max"]
ORACLE["stream_device_max_append"] = ORACLE["stream_device_max"]
# the same windows whether the log arrives as Parquet rows or as text files
ORACLE["stream_text_device_max"] = ORACLE["stream_device_max"]

ORACLE["stream_step_loss"] = f"""with {F4}
select time_bucket(interval '1 hour', ts) as window_start,
       time_bucket(interval '1 hour', ts) + interval '1 hour' as window_end,
       run_id, phase, epoch, {r12('sum(loss) / count(*)')} as mean_loss, count(*) as n
from f4 group by 1, 2, 3, 4, 5"""

# repeated rows, restarts and the order of reports change nothing
ORACLE["stream_step_loss_replayed"] = ORACLE["stream_step_loss"]
ORACLE["stream_percent_series"] = ORACLE["device_percent_series"]
ORACLE["stream_early_stop"] = ORACLE["early_stop"]


def _records(logged: str) -> str:
    """One record per chunk of a sound host's log (an empty one without a log)
    and one per failing host; ``logged`` says which lines there are."""
    return f"""with {F3}, {_fields('skip')},
per_dev as (select source, line_no // {PROFILE_CHUNK} as chunk, device, {{{_series}}} as s
            from fields where {logged} group by 1, 2, 3),
nested as (select source, chunk, map_from_entries(list({{'k': device, 'v': s}} order by device)) as profile
           from per_dev group by 1, 2),
inv as (select distinct source, device, gpu_memory_total from fields),
devs as (select source, list({{'name': 'GPU ' || source, 'device_id': device, 'memory': gpu_memory_total || ' MiB'}}
                             order by 'GPU ' || source, device, gpu_memory_total || ' MiB') as devices
         from inv group by source),
{VERSIONS}
select source, 0::BIGINT as chunk,
       to_json({{'error': '{BANNER_ERROR}', 'cuda_version': NULL::VARCHAR, 'driver_version': NULL::VARCHAR}}) as record_json
from v where not ok
union all
select v.source, coalesce(n.chunk, 0) as chunk,
       to_json({{'error': NULL::VARCHAR, 'cuda_version': v.c, 'driver_version': v.d, 'devices': d.devices,
                'profile': coalesce(n.profile, MAP {{}})}}) as record_json
from v left join devs d using (source) left join nested n using (source) where ok"""


ORACLE["device_profile_record"] = _records("true")
ORACLE["profile_records_all_hosts"] = _records("source <> 'host1'")

# The JSON sink reads back to the same records
ORACLE["profile_json_sink"] = ORACLE["device_profile_record"]

# S7 as VARIANT: a failing host's record has no devices
ORACLE["profile_variant_sink"] = f"""with r as ({ORACLE["device_profile_record"]})
select source, chunk, record_json->>'$.error' as error, record_json->>'$.driver_version' as driver_version,
       record_json->>'$.cuda_version' as cuda_version, record_json->>'$.devices[0].device_id' as first_device,
       record_json->>'$.devices[0].memory' as first_memory, record_json->>'$.devices[1].device_id' as second_device
from r"""

ORACLE["metric_rank_auc"] = """with x as (
  select vec_id % 5 as grp, floor(list_max(embedding)::DOUBLE * 1024)::BIGINT as s,
         list_position(embedding, list_max(embedding)) - 1 = label as good
  from embeddings where embedding is not null and label is not null),
c as (select grp, s, count(*) filter (where good) as p, count(*) filter (where not good) as n from x group by 1, 2),
b as (select *, coalesce(sum(n) over (partition by grp order by s rows between unbounded preceding and 1 preceding), 0) as below from c)
select grp, (sum(p * (2 * below + n))::DOUBLE / nullif(2 * sum(n)::DOUBLE * sum(p)::DOUBLE, 0)) as auc,
       sum(p)::DOUBLE as n_positive, sum(n)::DOUBLE as n_negative
from b group by grp"""

# the four further losses of an epoch add nothing to its sum at 12 places, and 4 to its count
ORACLE["epoch_loss_exact"] = f"""with {F4},
s as (select run_id, rank, epoch, phase, sum(loss::DECIMAL(18,10)) * 10000000000 as total, count(*) + 4 as n from f4 group by all),
t as (select *, total::HUGEINT as num, (n * 1000000)::HUGEINT as den from s)
select run_id, rank, epoch, phase, n as n_steps,
       (case when num < 0 then -1 else 1 end * (abs(num) // den + case when 2 * (abs(num) % den) > den
         or (2 * (abs(num) % den) = den and (abs(num) // den) % 2 = 1) then 1 else 0 end))::DOUBLE / 10000.0::DOUBLE as avg_loss
from t"""

# a byte-level vocabulary loses nothing, and pieces have the ids they have in whole texts
ORACLE["vocabulary_dictionary"] = f"with {F2} select row_id, source_text as source_decoded from f2"
ORACLE["vocabulary_tokenizer"] = f"""with {F2}
select row_id % 2 as grp, count(*) as n_rows, count(*) as n_same from f2 group by 1"""
