"""Default parameters.

Fixed values: these defaults equal the reference's configuration and
operator defaults, so that a user switching over gets the same behaviour.
"""

# Fixed values (reference configuration and operator defaults), in the
# reference's order:
THRESHOLD = 564            # indices above it are one-hot embedding candidates
MAX_SPEC_INDEX = 564       # transform-spec rows with indexnum <= this are used
FM_METHOD = "mcmc"         # reference default; no Spark counterpart (see operators.fm.fm_fit)
FM_NUM_ITER = 50
FM_DIM = 8
FM_INIT_STDEV = 0.1
FM_R0_REG = 0.1
FM_R1_REG = 0.1
FM_R2_REG = 0.1
FM_LEARN_RATE = 0.1
TRAIN_RATIO = 0.8
IS_APPEND = True
QUANTILE_RELATIVE_ERROR = 0.001
QUANTILE_NUM_BUCKETS = 2
BINARIZER_THRESHOLD = 0.0
NORMALIZER_P = 2.0
MIN_MAX_RANGE = (0.0, 1.0)
VECTOR_INDEXER_MAX_CATEGORIES = 20
FFM_LAMBDA = 2e-5
FFM_K = 4
FFM_ITERATIONS = 15
FFM_ETA = 0.2
FFM_INSTANCE_NORM = True

# Our own defaults
FM_SPARK_METHOD = "adamW"  # used where the reference default (mcmc) cannot run
