"""Plain versions of what operators do, for small inputs."""


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Words that each source should give, sources in their order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in full]
        left, spread = sum(sizes) - sum(cap * sizes[i] for i in full), sum(weight[i] for i in rest)
        share = [cap * n if i in full else left * weight[i] / spread for i, n in enumerate(sizes)]
        over = {i for i in rest if share[i] > cap * sizes[i]}
        if not over:
            return [float(x) for x in share]
        full |= over
