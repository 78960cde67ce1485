STOCK = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam".split()


def words(rng, n):
    """Invented words, nearly all different."""
    return " ".join(rng.choice(STOCK) + str(rng.randrange(100000)) for _ in range(n))
