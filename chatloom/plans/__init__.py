"""plans"""
