"""Table operators of the search index: predicates, text match, results, changes, sync."""
