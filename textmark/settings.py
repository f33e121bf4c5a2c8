"""Results depend on them, so they are stated once, here."""

# Marks run from very bad to very good; class indices are mark - 1.
LOWEST_MARK = 1
HIGHEST_MARK = 10

# A member that failed reports this mark instead of a real one.
FAILED_MARK = -1.0

# Share of the labelled rows a learner is fitted on; the rest scores it.
TRAIN_SHARE = 0.6

# Learner parameters.
BAYES_SMOOTHING = 0.1875
SVM_ITERATIONS = 10
SVM_REGULARISATION = 0.1
LOGISTIC_ITERATIONS = 10
LOGISTIC_TOLERANCE = 1e-6
PERCEPTRON_HIDDEN = 5
PERCEPTRON_BLOCK = 128
PERCEPTRON_ITERATIONS = 100
# Wider rows are not made dense for training.
PERCEPTRON_DENSE_WIDTH = 1024
TREE_MAX_CATEGORIES = 4
SHUFFLE_SEED = 1234

# Width of count and hashed vectors (Spark's own defaults).
VOCABULARY_SIZE = 1 << 18
HASH_BUCKETS = 1 << 18
# Width of hashed vectors for learners that hold dense values per place.
DENSE_BUCKETS = 1 << 12

# Size bounds.  Anything that may be larger takes a distributed path instead.
BROADCAST_ROWS = 300_000
BROADCAST_BYTES = 64 << 20
FREQUENT_BYTES = 8 << 20
# Arrow batches between Spark and Python; tasks hold several of them outside the heap.
BATCH_BYTES = 2 << 20
LITERAL_ENTRIES = 10_000
TOP_K_ROWS = 10_000
