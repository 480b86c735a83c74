"""Small literal fixtures."""

# expected centres and their points' spread for the four-cluster set
FOUR_CENTERS = [(-4.0, -43.0), (42.0, -48.0), (-36.0, 35.0), (25.0, 43.0)]

# edge list of four clusters
EDGES = [(0, 1, 10.0), (0, 2, 15.0), (0, 3, 12.0), (1, 2, 13.0), (1, 3, 14.0), (2, 3, 16.0)]

# dot products of six documents, and cluster of documents 1..6 after 0..5 merges
DOC_SIMS = {
    (1, 2): 38, (1, 3): 37, (1, 4): 14, (1, 5): 73, (1, 6): 24, (2, 3): 26, (2, 4): 8, (2, 5): 36,
    (2, 6): 30, (3, 4): 11, (3, 5): 42, (3, 6): 27, (4, 5): 75, (4, 6): 2, (5, 6): 51,
}
SINGLE_LEVELS = ["123456", "123556", "523556", "623666", "626666", "666666"]
MIN_LEVELS = ["123456", "123656", "163656", "166656", "666656", "666666"]

# age, income, student, credit -> buys a computer
BUY = [
    ([0.0, 2.0, 0.0, 0.0], "no"), ([0.0, 2.0, 0.0, 1.0], "no"), ([1.0, 2.0, 0.0, 0.0], "yes"),
    ([2.0, 1.0, 0.0, 0.0], "yes"), ([2.0, 0.0, 1.0, 0.0], "yes"), ([2.0, 0.0, 1.0, 1.0], "no"),
    ([1.0, 0.0, 1.0, 1.0], "yes"), ([0.0, 1.0, 0.0, 0.0], "no"), ([0.0, 0.0, 1.0, 0.0], "yes"),
    ([2.0, 1.0, 1.0, 0.0], "yes"), ([0.0, 1.0, 1.0, 1.0], "yes"), ([1.0, 1.0, 0.0, 1.0], "yes"),
    ([1.0, 2.0, 1.0, 0.0], "yes"), ([2.0, 1.0, 0.0, 1.0], "no"),
]
EIGHT = [([0.5, v], "A" if v < 0.45 else "B") for v in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 1.0)]

# one-feature points: value, class
TEN = [
    (-0.32, 0), (-1.1, 0), (0.4, 1), (1.2, 1), (0.9, 1), (-0.2, 0), (0.1, 0), (1.5, 1), (0.7, 1), (-0.1, 1),
]
