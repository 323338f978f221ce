"""plans of the keyframe engine."""
