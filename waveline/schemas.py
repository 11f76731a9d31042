"""Fixed schemas of everything the engine reads and writes, in column order."""

from __future__ import annotations

#: Raw and joined samples, as packed doubles. A trace, numbered by ``seq`` in the order of its
#: file, is in pieces: ``at`` is the place of a piece's first sample, ``n`` how many it has. A
#: segment is in blocks: ``n`` is the whole segment's length.
TRACE = "station string, chunk string, channel string, seq int, t0 double, fs double, at bigint, n int, data binary"
SEGMENT = "station string, chunk string, channel string, role string, seg_id int, t0 double, n bigint, block int, total double, data binary"
SPAN = "station string, chunk string, t0 double, seg_z int, off_z bigint, seg_n int, off_n bigint, seg_e int, off_e bigint, n bigint"

#: Sources.
STATION = "Code string, Latitude double, Longitude double"
CATALOG = "EventID bigint, Date string, Latitude double, Longitude double, Depth double, Magnitude double, Location string"
LEDGER = "station string, state string, start string, end string"

#: Products.
SCORES = "t double, p float"
SNR = "event_id bigint, time timestamp, mag double, dist_km double, depth double, snr double, location string"
BASELINE = "station string, role string, mu double, sigma double, sigma_trimmed double, sigma_median double, n_samples bigint, n_pieces bigint"
CONDITIONING = "fs double, freqmin double, freqmax double, piece_seconds double, trim double, bands array<string>, chunks map<string, string>"
WINDOWS = "station string, chunk string, event_id bigint, length_s double, kind string, tag string, t0 double, comps array<string>, samples array<array<int>>"
COINCIDENCE = (
    "budget_per_day double, separation_km double, joint_days double, coincidence_seconds double, station_a string, station_b string, "
    "thr_a double, thr_b double, a_per_day double, b_per_day double, both_per_day double, independent_per_day double, "
    "excess_over_independent double, recall_both double"
)
COMPLETED = "station string, chunk string, product string, outputs bigint"
