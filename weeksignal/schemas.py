"""Column types of the tables that cross a file boundary, as DDL strings."""

from __future__ import annotations

RAW_NEWSLETTER = ("source string, date string, title string, url string, text string")
PAPERS = (
    "source string, query string, title string, abstract string, published string, citation_count bigint, url string"
)
STORIES = (
    "source string, query string, title string, url string, author string, points bigint, "
    "num_comments bigint, published string, week string, hn_id string"
)
POSTS = (
    "source string, subreddit string, title string, text string, author string, score bigint, "
    "num_comments bigint, published string, week string, post_id string, url string"
)
REPOSITORIES = (
    "source string, query string, repo_id string, name string, description string, stars bigint, "
    "forks bigint, language string, topics string, published string, week string, url string"
)
PHRASES = ("phrase string, score double, source string, date string, week string")
TOPIC_MAP = (
    "phrase string, score double, source string, date string, week string, canonical_topic string, similarity double"
)
CANONICAL_TOPICS = ("canonical_topic string, type string")

# API payloads as landed: one document per response.
HN_RESPONSE = (
    "query string, hits array<struct<title:string, url:string, author:string, points:bigint, "
    "num_comments:bigint, created_at:string, objectID:string>>"
)
REDDIT_RESPONSE = (
    "subreddit string, data array<struct<id:string, title:string, selftext:string, author:string, "
    "score:bigint, num_comments:bigint, created_utc:double, permalink:string>>"
)
GITHUB_RESPONSE = (
    "query string, items array<struct<id:bigint, full_name:string, description:string, stargazers_count:bigint, "
    "forks_count:bigint, language:string, topics:array<string>, created_at:string, html_url:string>>"
)
S2_RESPONSE = (
    "query string, data array<struct<paperId:string, title:string, abstract:string, publicationDate:string, "
    "year:int, citationCount:bigint>>"
)
ATOM_ENTRY = ("title string, summary string, published string, id string")
