import gc

from phenoloom.llm.words import release


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_freed_memory_goes_back():
    """Between many small blocks that stay, freed ones leave holes that the allocator keeps until it is asked."""
    gc.collect()
    blocks = [bytes(3000) for _ in range(100_000)]
    full = resident()
    kept = blocks[::16]
    del blocks
    release()
    assert len(kept) and full - resident() > 150_000_000
