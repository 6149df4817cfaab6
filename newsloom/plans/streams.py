"""Streaming queries; each runs what is there and ends."""

from __future__ import annotations

from ..streaming import events
from .common import Registry
from .matching import sql_first
from .scalars import sql_norm

query = Registry()


@query("stream_daily_counts", "select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n from events group by 1, 2")
def stream_daily_counts(s, d):
    return events.daily_counts(s, d)


@query("stream_first_of_user", "select distinct user_id, event_type from events")
def stream_first_of_user(s, d):
    return events.first_of_user(s, d)


@query("stream_sessions", "with e as (select user_id, epoch(ts) t, case when epoch(ts) - lag(epoch(ts)) over (partition by user_id order by ts) <= 72 * 3600 then 0 else 1 end b from events), g as (select *, sum(b) over (partition by user_id order by t) k from e) select user_id, cast(floor(min(t)) as bigint) as started, count(*) as n from g group by user_id, k")
def stream_sessions(s, d):
    return events.sessions(s, d)


_INCOMING = f"(select incoming_seq as article_seq, sha256(coalesce(canonical_url, '')) as c, sha256({sql_norm('title_original')}) as t from incoming_articles)"


@query("stream_ingest", f"select article_seq as incoming_seq, c as canonical_hash, t as title_hash from ({sql_first(_INCOMING)}) join {_INCOMING} using (article_seq)")
def stream_ingest(s, d):
    return events.ingest(s, d)
