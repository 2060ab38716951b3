"""The fixtures in SQL, as named parts that an oracle query builds on."""

from verbatide.functions.lexicons import KEYWORDS, RULES

SPACES = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def hits(text: str, words) -> str:
    tests = [
        "contains({}, '{}')::int".format(text, word.replace("'", "''")) for word in words
    ]
    return "(" + " + ".join(tests) + ")"


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{SPACES}]+'))::int"


PARTS = {}

PARTS["comments"] = r"""
select 'd' || d.doc_id as id, 'user_' || e.user_id as author,
  case d.doc_id % 6
    when 0 then d.text
    when 1 then d.text || ' good great love https://x.example/a?b=1 @bob #tag'
    when 2 then 'this is bad and awful, ' || d.text
    when 3 then d.text || ' what a great, excellent, amazing and fantastic day'
    when 4 then d.text || ' I can''t like this, why?'
    else 'worst: ' || d.text || ' [removed] it' end as text,
  floor(e.value)::int as score, (e.event_id % 6)::int as depth, e.ts as created_utc,
  d.source as subreddit, 'p' || (d.doc_id % 100) as post_id
from documents d left join events e on e.event_id = d.doc_id
union all
select 'e' || event_id, case when event_id % 50 <> 0 then 'user_' || user_id end,
  case event_id % 12
    when 0 then null when 1 then '' when 2 then '   ' when 3 then '[deleted]'
    when 4 then '[removed]' when 5 then 'ok' when 6 then 'I dislike this but why?'
    when 7 then 'good great #win ' || event_type
    when 8 then 'bad terrible awful hate ' || props
    when 9 then event_type || ' was fantastic, thanks @user_' || user_id
    when 10 then 'nothing works, see http://x.example/' || event_id
    else event_type || chr(9) || chr(13) || chr(10) || props end,
  floor(value)::int, (event_id % 6)::int, ts, event_type, 'p' || (event_id % 100)
from events
"""

PARTS["ingested"] = r"""
select *, case when text is null or length(text) < 3 or contains(text, '[deleted]')
    or contains(text, '[removed]') then 'invalid' else 'valid' end as is_valid
from (select * replace (case when text is null or text = '' then null
        else trim(regexp_replace(text, '[\r\n\t]+', ' ', 'g'), ' ') end as text),
        length(text)::int as comment_length from comments)
"""

PARTS["valid"] = "select * from ingested where is_valid = 'valid'"

PARTS["clean_all"] = r"""
select *, len(string_split(text_cleaned, ' '))::int as word_count, comment_length as text_length
from (select *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
    'http[^\s\x0B]+|www[^\s\x0B]+', '', 'g'), '@\w+|#\w+', '', 'g'),
    '[^a-zA-Z0-9\s\x0B]', '', 'g'), '[\s\x0B]+', ' ', 'g') as text_cleaned from valid)
"""

PARTS["cleaned"] = "select * from clean_all where word_count >= 2 and text_length >= 10"

PARTS["keyword_balance"] = (
    "select *, "
    + hits("lower(text_cleaned)", KEYWORDS.positive)
    + " - "
    + hits("lower(text_cleaned)", KEYWORDS.negative)
    + " as balance from cleaned"
)

PARTS["keyword_scored"] = """
select * exclude (balance, conf), conf as confidence,
  case when balance > 0 then 'positive' when balance < 0 then 'negative' else 'neutral' end
    as sentiment,
  case when balance > 0 then conf else (1 - conf) / 2 end as positive_prob,
  case when balance < 0 then conf else (1 - conf) / 2 end as negative_prob,
  case when balance = 0 then conf else 1 - conf end as neutral_prob,
  'simple-keyword' as model_version
from (select *, case when balance = 0 then 0.5::double
   else least(0.6::double + abs(balance) * 0.1::double, 0.9::double) end as conf
   from keyword_balance)
"""


def rule_parts(source: str) -> str:
    return f"""
select * exclude (tally, question, words),
  case when tally > 0.5 then 'Positive' when tally < -0.5 then 'Negative'
    when question > 0 then 'Neutral' when words > 50 then 'Negative' else 'Positive' end
    as sentiment_label,
  case when abs(tally) > 0.5 then least(65::double + 8::double * abs(tally), 92::double)
    when question > 0 then 55::double when words > 50 then 58::double else 62::double end
    as confidence_score
from (select *, {hits("lower(text)", RULES.positive)} - {hits("lower(text)", RULES.negative)}
    - {hits("lower(text)", RULES.negation)} * 0.5::double as tally,
    {hits("lower(text)", RULES.question)} as question, {words("text")} as words
    from {source})
"""


PARTS["rule_cleaned"] = rule_parts("cleaned")

PARTS["scored"] = """
select id, author, text, score, created_utc, subreddit, text_cleaned, word_count, text_length,
  sentiment, confidence, positive_prob, negative_prob, neutral_prob, model_version
from keyword_scored where substring(id, 2)::bigint % 2 = 0
union all
select id, author, text, score, created_utc, subreddit, text_cleaned, word_count, text_length,
  lower(sentiment_label), confidence_score / 100,
  case when sentiment_label = 'Positive' then confidence_score else 100 - confidence_score end
    / 100,
  case when sentiment_label = 'Negative' then confidence_score else 100 - confidence_score end
    / 100,
  0.1::double, 'lexicon-v2'
from rule_cleaned where substring(id, 2)::bigint % 2 = 1
"""

PARTS["features"] = f"""
select *, length(text)::int as comment_length, {words("text")} as word_count,
  contains(text, 'http') as contains_url, contains(text, '?') as is_question
from comments
"""

PARTS["enriched"] = """
select *, case when comment_length < 50 then 'short' when comment_length < 200 then 'medium'
    else 'long' end as category,
  case when comment_length > 0 and comment_length <= 50 then 'short'
    when comment_length > 50 and comment_length <= 200 then 'medium'
    when comment_length > 200 then 'long' end as category_cut,
  score + word_count * 0.1::double as engagement_score
from features
where text is not null and text not in ('', '[deleted]', '[removed]')
"""

PARTS["rule_scored"] = rule_parts("enriched")

PARTS["logits"] = """
select event_id, value / 100 - 0.5::double as logit, (event_type = 'purchase')::int as label
from events
"""

PARTS["hits"] = """
select *, ((1 / (1 + exp(-logit)) > 0.5)::int = label)::int as hit,
  greatest(logit, 0::double) - logit * label + ln(1 + exp(-abs(logit))) as loss
from logits
"""

# Which parts each part reads.
NEEDS = {
    "comments": (),
    "ingested": ("comments",),
    "valid": ("ingested",),
    "clean_all": ("valid",),
    "cleaned": ("clean_all",),
    "keyword_balance": ("cleaned",),
    "keyword_scored": ("keyword_balance",),
    "rule_cleaned": ("cleaned",),
    "scored": ("keyword_scored", "rule_cleaned"),
    "features": ("comments",),
    "enriched": ("features",),
    "rule_scored": ("enriched",),
    "logits": (),
    "hits": ("logits",),
}


def using(part: str, select: str) -> str:
    """``select`` with ``part`` and all it needs in front."""
    ordered = []

    def add(name):
        for needed in NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    add(part)
    parts = ",\n".join(f"{name} as ({PARTS[name].strip()})" for name in ordered)
    return f"with {parts}\n{select.strip()}"
