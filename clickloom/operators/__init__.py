"""DataFrame operators.

A single visitor, session, address or article may hold a large share of all
rows.  No operator here sorts or collects such a group in one task: rows are
first reduced by aggregates that combine before the shuffle, ordered work is
done per time slot, and slots are stitched together through their summaries.
"""
