"""Registered queries, each with the SQL it is checked against where one exists."""

from lexistat.plans import (
    classification,
    crawl,
    modelling,
    publications,
    retrieval,
    statistics,
    storage,
)

GROUPS = (retrieval, crawl, publications, statistics, modelling, classification, storage)
