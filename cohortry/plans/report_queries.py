"""Queries of filters, reports and reminders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import DAY, FIRST_DAY, view, with_views
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import flatten as L
from ..operators import windows as W
from ..session import table
from .extensions import REPORTS, register_report
from .registry import query

START, END = FIRST_DAY, FIRST_DAY + 20 * DAY
TODAY = 19723 + 12  # 2024-01-13 as days since 1970
CONFIG = {"length": 14, "head": 2, "tail": 1, "n_miss": 3, "n_consec": 2, "n_done": 6, "cutoff": 5}
_OFFSETS = "case time_zone when '-07:00' then -420 when '-05:00' then -300 when '+01:00' then 60 when '-11:00' then -660 when '-01:00' then -60 end"


@query(with_views("participants records", "select record_id, user_id from records r where sharing_scope <> 'no_sharing' and not exists (select 1 from participants p where p.user_id = r.user_id and p.sharing_scope = 'no_sharing')"))
def shareable_records(spark, sf_dir):
    return P.shareable_records(view(spark, sf_dir, "records"), view(spark, sf_dir, "participants")).select("record_id", "user_id")


@query(with_views("studies", "select study_id from studies where export_enabled is true and configured is true"))
def export_configured(spark, sf_dir):
    return P.export_configured(view(spark, sf_dir, "studies")).select("study_id")


@query(with_views("studies", "select study_id from studies where export_enabled is true and configured is true and table_id is not null and view_id is not null"))
def demographics_configured(spark, sf_dir):
    return P.demographics_configured(view(spark, sf_dir, "studies")).select("study_id")


@query(with_views("studies", "select study_id from studies where project_id is not null and team_id is not null and study_id like '%1%'"))
def tabulation_configured(spark, sf_dir):
    apps = view(spark, sf_dir, "studies").withColumn("providers", F.when(F.contains("study_id", F.lit("1")), F.create_map(F.lit("wearable"), F.lit("x"))).otherwise(F.create_map(F.lit("other"), F.lit("x"))))
    return P.tabulation_configured(apps, "wearable").select("study_id")


@query(with_views("studies", "select app_id, study_id from studies where app_id in ('app1', 'app3')"))
def app_whitelist(spark, sf_dir):
    return P.app_whitelist(view(spark, sf_dir, "studies"), ["app1", "app3"]).select("app_id", "study_id")


def _reportable(spark, sf_dir):
    studies = view(spark, sf_dir, "studies")
    apps = studies.select("app_id").distinct().withColumn("adherence_enabled", F.when(F.col("app_id") == "app2", F.lit(None)).otherwise(F.lit(True)))
    selected = studies.filter("app_id = 'app1' and study_id > 'study2'").select("app_id", "study_id")
    return P.reportable_studies(apps, studies, selected)


_REPORTABLE = "select * from studies where app_id <> 'app2' and phase in ('design', 'recruitment', 'in_flight') and schedule_guid is not null and (app_id <> 'app1' or study_id > 'study2')"


@query(with_views("studies", f"select app_id, study_id, coalesce(threshold, 0) as threshold from ({_REPORTABLE})"))
def reportable_studies(spark, sf_dir):
    return _reportable(spark, sf_dir).select("app_id", "study_id", F.coalesce("threshold", F.lit(0)).alias("threshold"))


_CONSENTED = """(select p.* from participants p left join (select user_id, withdrew_ms, row_number() over (partition by user_id order by signed_ms desc) as k from consents) c on c.user_id = p.user_id and k = 1
    where list_contains(data_groups, 'clinical_consent') or list_contains(data_groups, 'test_no_consent') or (c.user_id is not null and c.withdrew_ms is null))"""


@query(with_views("participants consents", f"select user_id from {_CONSENTED}"))
def consented_users(spark, sf_dir):
    return P.consented_users(view(spark, sf_dir, "participants"), view(spark, sf_dir, "consents")).select("user_id")


_LATEST = """(select user_id, time_ms, case when trim(coalesce(type, '')) = '' then 'UNKNOWN' else type end as type from (select *, row_number() over (partition by user_id order by time_ms desc, seq desc) as k from notification_log) where k = 1)"""


@query(with_views("notification_log", f"select user_id, time_ms, type from {_LATEST}"))
def latest_notification(spark, sf_dir):
    return A.latest_notification(view(spark, sf_dir, "notification_log"))


_AS_OF = FIRST_DAY + 24 * DAY


@query(with_views("participants notification_log", f"select user_id from participants where user_id not in (select user_id from {_LATEST} where type <> 'PRE_BURST' and time_ms > {_AS_OF - 3 * DAY})"))
def reminder_cooldown(spark, sf_dir):
    return P.reminder_cooldown(view(spark, sf_dir, "participants"), A.latest_notification(view(spark, sf_dir, "notification_log")), 3, _AS_OF).select("user_id")


@query(with_views("participants consents notification_log", f"select user_id from {_CONSENTED} where phone_verified is not false and time_zone in ('-07:00', '-05:00', '-11:00', '-01:00') and not list_contains(data_groups, 'groupB') and user_id not in (select user_id from {_LATEST} where type <> 'PRE_BURST' and time_ms > {_AS_OF - 3 * DAY})"))
def reminder_eligible_users(spark, sf_dir):
    log = A.latest_notification(view(spark, sf_dir, "notification_log"))
    return P.reminder_eligible_users(view(spark, sf_dir, "participants"), view(spark, sf_dir, "consents"), log, ["groupB"], 3, _AS_OF).select("user_id")


@query(with_views("activity_events", "select app_id, user_id, seq from activity_events where event_id = 'signup' or (event_id = 'click' and app_id = 'app1')"))
def burst_start_events(spark, sf_dir):
    events = view(spark, sf_dir, "activity_events")
    config = events.select("app_id").distinct().withColumn("start_event_ids", F.when(F.col("app_id") == "app1", F.array(F.lit("signup"), F.lit("click"))).otherwise(F.array(F.lit("signup"))))
    return P.burst_start_events(events, config).select("app_id", "user_id", "seq")


@query(with_views("participants", "select user_id from participants where len(roles) = 0"))
def non_staff(spark, sf_dir):
    return P.non_staff(view(spark, sf_dir, "participants")).select("user_id")


@query(with_views("participants", "select user_id, phone from participants where phone is not null"))
def phone_accounts(spark, sf_dir):
    return P.phone_accounts(view(spark, sf_dir, "participants"), True).select("user_id", "phone")


@query(with_views("uploads", f"select app_id, lower(status) as status, count(*) as n from uploads where requested_ms between {START} and {END} group by all"))
def uploads_by_status(spark, sf_dir):
    return A.uploads_by_status(view(spark, sf_dir, "uploads"), START, END)


@query(with_views("uploads", f"select app_id, '-daily-upload-report' as report_id, '2024-01-01' as date, lower(status) as status, count(*) as n from uploads where requested_ms between {START} and {END} group by all"))
def report_frame(spark, sf_dir):
    return A.report_frame(A.uploads_by_status(view(spark, sf_dir, "uploads"), START, END), "app_id", "-daily-upload-report", "2024-01-01T23:30:00-08:00")


_MEMBERS = "(select * from (values ('by_status', 'enabled'), ('by_status', 'disabled'), ('by_status', 'unverified'), ('by_sharing', 'no_sharing'), ('by_sharing', 'sponsors_and_partners'), ('by_sharing', 'all_qualified_researchers')) t(metric, key))"


@query(with_views("participants", f"""select a.app_id, m.metric, m.key, coalesce(n, 0) as n from (select distinct app_id from participants) a cross join {_MEMBERS} m left join (
    select app_id, 'by_status' as metric, status as key, count(*) as n from participants where len(roles) = 0 and created_ms between {START} and {END} group by all
    union all select app_id, 'by_sharing', sharing_scope, count(*) from participants where len(roles) = 0 and status = 'enabled' and created_ms between {START} and {END} group by all) c on c.app_id = a.app_id and c.metric = m.metric and c.key = m.key"""))
def signups_report(spark, sf_dir):
    members = spark.createDataFrame([("by_status", k) for k in ("enabled", "disabled", "unverified")] + [("by_sharing", k) for k in ("no_sharing", "sponsors_and_partners", "all_qualified_researchers")], "metric string, key string")
    return A.signups_report(view(spark, sf_dir, "participants"), START, END, members)


@query(with_views("activity_events", "select app_id, user_id, min(ts_ms) as start_ms from activity_events where event_id = 'signup' group by all"))
def first_start_event(spark, sf_dir):
    return A.first_start_event(view(spark, sf_dir, "activity_events"), "signup")


_HISTOGRAM = f"""(select app_id, metric, day, count(*) as n from (select app_id, unnest(['by_sign_in', 'by_uploaded_on']) as metric, unnest([s, u]) as day from (
    select e.app_id, (signed_in_ms - start_ms) // {DAY} + case when signed_in_ms < start_ms and (signed_in_ms - start_ms) % {DAY} <> 0 and (signed_in_ms - start_ms) // {DAY} < (signed_in_ms - start_ms) / {DAY} then 1 else 0 end as s,
        (uploaded_ms - start_ms) // {DAY} + case when uploaded_ms < start_ms and (uploaded_ms - start_ms) % {DAY} <> 0 and (uploaded_ms - start_ms) // {DAY} < (uploaded_ms - start_ms) / {DAY} then 1 else 0 end as u
    from (select user_id from participants where len(roles) = 0) p join (select app_id, user_id, min(ts_ms) as start_ms from activity_events where event_id = 'signup' group by all) e on e.user_id = p.user_id left join request_info r on r.user_id = p.user_id)
    where s is null or s >= 0) where day >= 0 group by all)"""


def _histogram(spark, sf_dir):
    return A.retention_histogram(*(view(spark, sf_dir, v) for v in ("participants", "activity_events", "request_info")), event_id="signup")


@query(with_views("participants activity_events request_info", f"select * from {_HISTOGRAM}"))
def retention_histogram(spark, sf_dir):
    return _histogram(spark, sf_dir)


_CURVE = f"(select l.app_id, l.metric, d.day, (select coalesce(sum(n), 0)::bigint from h where h.app_id = l.app_id and h.metric = l.metric and h.day >= d.day) as n from (select app_id, metric, max(day) as last from h group by all) l, (select unnest(range(0, 400)) as day) d where d.day <= l.last)"


@query(with_views("participants activity_events request_info", f"select * from (with h as (select * from {_HISTOGRAM}) select * from {_CURVE})"))
def retention_curve(spark, sf_dir):
    return W.retention_curve(_histogram(spark, sf_dir))


register_report("retention", lambda spark, sf_dir: W.retention_curve(_histogram(spark, sf_dir)))
register_report("uploads", lambda spark, sf_dir: A.uploads_by_status(view(spark, sf_dir, "uploads"), START, END))


@query(with_views("uploads", f"select 'uploads' as kind, app_id, sum(n)::bigint as n from (select app_id, count(*) as n from uploads where requested_ms between {START} and {END} group by all) group by all"), name="register_report")
def reports_by_kind(spark, sf_dir):
    return REPORTS["uploads"](spark, sf_dir).groupBy(F.lit("uploads").alias("kind"), "app_id").agg(F.sum("n").alias("n"))


def _offsets(spark, sf_dir):
    return view(spark, sf_dir, "participants").select("user_id", S.offset_minutes("time_zone").alias("offset_minutes")).filter("offset_minutes is not null")


def _starts(spark, sf_dir):
    return view(spark, sf_dir, "activity_events").filter("event_id = 'signup'").join(_offsets(spark, sf_dir), "user_id")


def _days(spark, sf_dir):
    return W.dedupe_activities_by_day(view(spark, sf_dir, "scheduled_activities").join(_offsets(spark, sf_dir), "user_id"))


_O = f"o as (select user_id, {_OFFSETS} as off from participants where time_zone is not null)"
_ACTS = f"acts as (select * from (select a.user_id, ((scheduled_ms + off * 60000) // {DAY}) as day, status, seq, count(*) over (partition by a.user_id, ((scheduled_ms + off * 60000) // {DAY})) as of_day, row_number() over (partition by a.user_id, ((scheduled_ms + off * 60000) // {DAY}) order by scheduled_ms, seq) as k from scheduled_activities a join o on o.user_id = a.user_id) where k = 1)"
_STARTED = f"starts as (select e.user_id, ts_ms, seq, ((ts_ms + off * 60000) // {DAY}) as start_day from activity_events e join o on o.user_id = e.user_id where event_id = 'signup')"
_CURRENT = f"cur as (select user_id, start_day from (select *, row_number() over (partition by user_id order by ts_ms, seq) as k from starts where {TODAY} between start_day and start_day + {CONFIG['length']} - 1) where k = 1 and {TODAY} between start_day + {CONFIG['head']} and start_day + {CONFIG['length']} - 1 - {CONFIG['tail']})"
_CALENDAR = f"cal as (select c.user_id, d.day - c.start_day as day_idx, d.day, coalesce(a.status = 'finished', false) as finished from cur c join (select unnest(range({TODAY} - 40, {TODAY} + 1)) as day) d on d.day >= c.start_day left join acts a on a.user_id = c.user_id and a.day = d.day)"
_RUNS = "runs as (select *, sum((not finished)::int) over w as n_missed, sum(finished::int) over w as n_finished, case when finished then 0 else day_idx - max(case when finished then day_idx else -1 end) over w end as run from cal window w as (partition by user_id order by day_idx rows unbounded preceding))"
_DECIDED = f"""dec as (select user_id, verdict as decision from (select *, row_number() over (partition by user_id order by day_idx) as k from (select *, case when not finished and n_missed >= {CONFIG['n_miss']} then 'CUMULATIVE' when not finished and run >= {CONFIG['n_consec']} then case when day_idx < {CONFIG['cutoff']} then 'EARLY' else 'LATE' end when finished and n_finished >= {CONFIG['n_done']} then 'DONE' end as verdict from runs) where verdict is not null) where k = 1 and verdict <> 'DONE' and user_id not in (select user_id from runs where day = {TODAY} and finished))"""
_VIEWS = "participants activity_events scheduled_activities"


def _with(parts, select):
    return with_views(_VIEWS, f"select * from (with {', '.join(parts)} {select})")


@query(_with([_O, _ACTS], "select user_id, day, status, of_day, seq from acts"))
def dedupe_activities_by_day(spark, sf_dir):
    return _days(spark, sf_dir).select("user_id", "day", "status", "of_day", "seq")


@query(_with([_O, _STARTED, _CURRENT], "select user_id, start_day from cur"))
def current_burst(spark, sf_dir):
    return W.current_burst(_starts(spark, sf_dir), TODAY, CONFIG["length"], CONFIG["head"], CONFIG["tail"])


@query(_with([_O, _STARTED], f"select distinct user_id, 'PRE_BURST' as decision from starts where start_day - 1 = {TODAY}"))
def upcoming_burst(spark, sf_dir):
    return W.upcoming_burst(_starts(spark, sf_dir), TODAY)


def _calendar(spark, sf_dir):
    return W.burst_calendar(current_burst(spark, sf_dir), _days(spark, sf_dir), TODAY)


@query(_with([_O, _ACTS, _STARTED, _CURRENT, _CALENDAR], "select user_id, day_idx::int as day_idx, day, finished from cal"))
def burst_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir)


@query(_with([_O, _ACTS, _STARTED, _CURRENT, _CALENDAR, _RUNS], "select user_id, day_idx::int as day_idx, n_missed::bigint as n_missed, n_finished::bigint as n_finished, run::bigint as run from runs"))
def missed_day_runs(spark, sf_dir):
    return W.missed_day_runs(_calendar(spark, sf_dir)).select("user_id", "day_idx", "n_missed", "n_finished", "run")


_LIMITS = {k: CONFIG[k] for k in ("n_miss", "n_consec", "n_done", "cutoff")}


@query(_with([_O, _ACTS, _STARTED, _CURRENT, _CALENDAR, _RUNS, _DECIDED], "select user_id, decision from dec"))
def burst_decision(spark, sf_dir):
    return W.burst_decision(W.missed_day_runs(_calendar(spark, sf_dir)), **_LIMITS)


@query(_with([_O, _ACTS, _STARTED, _CURRENT, _CALENDAR, _RUNS, _DECIDED], "select user_id, decision from dec"))
def burst_decision_fold(spark, sf_dir):
    """The decisions of the day from a state that goes from day to day, each written and read again."""
    from .export_queries import _folder

    starts, acts, path = _starts(spark, sf_dir), _days(spark, sf_dir), _folder(spark, "bursts")
    state = spark.createDataFrame([], W.BURST_STATE)
    for day in range(TODAY - CONFIG["length"] + 1, TODAY + 1):
        W.advance_bursts(state, starts, acts, day, CONFIG["length"], **_LIMITS).write.parquet(f"{path}/day={day}")
        state = spark.read.schema(W.BURST_STATE).parquet(f"{path}/day={day}")
    return W.state_decisions(state, starts, TODAY, CONFIG["length"], CONFIG["head"], CONFIG["tail"])


_COMMITMENT = "com as (select p.user_id, case when json_valid(data) then json_extract_string(case when json_valid(data) then data end, '$.benefits') end as commitment from participants p left join (select user_id, data, row_number() over (partition by user_id order by seq) as k from report_data where report_id = 'Engagement' and report_date = '2000-12-31') r on r.user_id = p.user_id and k = 1)"


@query(with_views("participants report_data", f"select * from (with {_COMMITMENT} select user_id, commitment from com)"))
def study_commitment(spark, sf_dir):
    from ..operators.joins import study_commitment as commitment

    return commitment(view(spark, sf_dir, "participants"), view(spark, sf_dir, "report_data"))


MESSAGES = {"CUMULATIVE": ["c0 ${url}", "c1 ${url}"], "EARLY": ["e0", "e1 ${url}", "e2"], "LATE": ["l0 ${url}"]}
BY_GROUP = {"groupA": ["keep ${studyCommitment} at ${url}"], "clinical_consent": ["for ${studyCommitment}"]}


def _messages(spark, sf_dir):
    from ..operators.joins import study_commitment as commitment

    people = view(spark, sf_dir, "participants")
    decided = W.burst_decisions(_starts(spark, sf_dir), _days(spark, sf_dir), TODAY, **CONFIG)
    return L.reminder_messages(decided, people, commitment(people, view(spark, sf_dir, "report_data")), MESSAGES, BY_GROUP, "soon ${url}", "http://app", "2024-01-13")


_PICK = "list_extract({0}, 1 + (concat('0x', substr(md5(concat(cast(user_id as varchar), '2024-01-13')), 1, 8))::ubigint % len({0}))::bigint)"
_MESSAGE = f"""select user_id, decision, case when msg like '%${{studyCommitment}}%' and commitment is null then null else replace(replace(msg, '${{url}}', 'http://app'), '${{studyCommitment}}', coalesce(commitment, '')) end as message from (
    select *, {_PICK.format('list_')} as msg from (select d.user_id, d.decision, commitment, case decision when 'CUMULATIVE' then ['c0 ${{url}}', 'c1 ${{url}}'] when 'EARLY' then ['e0', 'e1 ${{url}}', 'e2'] when 'LATE' then ['l0 ${{url}}']
        else case when commitment is null then ['soon ${{url}}'] when list_contains(data_groups, 'groupA') then ['keep ${{studyCommitment}} at ${{url}}'] when list_contains(data_groups, 'clinical_consent') then ['for ${{studyCommitment}}'] else ['soon ${{url}}'] end end as list_
    from (select * from dec where user_id not in (select user_id from starts where start_day - 1 = {TODAY}) union all select distinct user_id, 'PRE_BURST' from starts where start_day - 1 = {TODAY}) d join participants p on p.user_id = d.user_id left join com on com.user_id = d.user_id)) """
_MESSAGES = with_views(_VIEWS + " report_data", f"select user_id, decision, message from (with {', '.join([_O, _ACTS, _STARTED, _CURRENT, _CALENDAR, _RUNS, _DECIDED, _COMMITMENT])} {_MESSAGE}) where message is not null")


@query(_MESSAGES)
def reminder_messages(spark, sf_dir):
    return _messages(spark, sf_dir)


@query(with_views("uploads", "select app_id, count(*) as bad, 100::bigint as bad_limit, count(*) < 100 as passed from uploads where status = 'error' group by all"))
def error_budget(spark, sf_dir):
    return P.error_budget(view(spark, sf_dir, "uploads").filter("status = 'error'"))


@query(with_views("participants studies", """select q.request_id from (select user_id * 3 as request_id, user_id, concat('study', cast(user_id % 25 as varchar)) as study_id from participants) q join participants p on p.user_id = q.user_id
    where email is not null and email_verified and (list_contains(roles, 'researcher') or list_contains(roles, 'study_coordinator')) and (not list_contains(roles, 'study_coordinator') or exists (select 1 from studies s where s.study_id = q.study_id and concat('org', cast(p.user_id % 4 as varchar)) = replace(s.app_id, 'app', 'org')))"""))
def roster_authorized(spark, sf_dir):
    people = view(spark, sf_dir, "participants").withColumn("org_id", F.concat(F.lit("org"), (F.col("user_id") % 4).cast("string")))
    requests = people.select((F.col("user_id") * 3).alias("request_id"), "user_id", F.concat(F.lit("study"), (F.col("user_id") % 25).cast("string")).alias("study_id"))
    sponsors = view(spark, sf_dir, "studies").select(F.replace("app_id", F.lit("app"), F.lit("org")).alias("org_id"), "study_id")
    return P.roster_authorized(requests, people, sponsors).select("request_id")


@query("""select o_orderkey, concat_ws(';', case when o_orderkey % 5 = 0 then 'app is required' end, case when o_orderkey % 7 > 3 then 'start is after end' end, case when o_orderstatus = 'P' then 'status is unknown' end) as reasons from orders""")
def validate_requests(spark, sf_dir):
    r = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(" ")).otherwise(F.lit("a")).alias("app"), (F.col("o_orderkey") % 7).alias("start"), F.lit(3).alias("end"), F.col("o_orderstatus").alias("status"))
    return P.validate_requests(r, ["app"], "start", "end", {"status": ["O", "F"]}).select("o_orderkey", F.array_join("reasons", ";").alias("reasons"))
